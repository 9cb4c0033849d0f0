"""Small pieces that several operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_BYTES = "4m"


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies; every worker has the same files."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Rows handed to Python at once: few, as one text may be very long, and few bytes, as a
    batch is held by the executor, the worker and its lists, of each task.  A row of its own
    that is larger is a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_key() -> Column:
    """128 bits that tell rows apart by number, source and text.  Each part is marked as
    null or set and the source's length stands before it, so no two rows read alike."""
    source, text = F.col("source").cast("string"), F.col("text").cast("string")
    part = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    whole = F.concat_ws(",", part(F.col("doc_id").cast("string")), part(F.octet_length(source).cast("string")), part(source), part(text))
    return F.unhex(F.md5(whole.cast("binary")))


def under_numbers(docs: DataFrame, needed: tuple[str, ...], missing: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """``docs`` with all columns but the ``needed`` ones named by their place, so that no name
    an operator uses can clash, and these names in order; ``toDF`` brings the old ones back.
    Columns in ``missing`` that the table lacks are added as null strings."""
    inner = [c if c in needed else f"extra{i}" for i, c in enumerate(docs.columns)]
    added = {c: F.lit(None).cast("string") for c in missing if c not in docs.columns}
    docs = docs.toDF(*inner)
    return (docs.withColumns(added) if added else docs), inner


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns))


def rows_of_all(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        if batch.num_rows:
            yield from rows_of(batch)


def one_task_each(rows: DataFrame, most: int = 20_000) -> DataFrame:
    """Deals out a table of few rows with much work behind each; adaptive execution, which
    sees only the rows' bytes, doesn't put them together again."""
    return rows.repartition(max(1, min(most, rows.count())))


def arrow_schema(ddl: dict[str, pa.DataType]) -> pa.Schema:
    return pa.schema(list(ddl.items()))


def from_uri(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def open_folder(uri: str):
    """The file system of a path, and the path in it.  Tasks use it for the files they
    write to the shared folder; tables go through Spark's own readers."""
    from pyarrow import fs

    uri = re.sub(r"^s3[an]://", "s3://", uri)  # Spark's names of the same store
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return from_uri(uri)
    return fs.LocalFileSystem(), uri
