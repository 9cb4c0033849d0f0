"""The state: which files and archives earlier runs have published.

Working form: a parquet table that only grows.  Each run adds one partition
``source=<who>/batch=<id>`` with its new keys, so a run costs what is new, not what is
known.  Batch ids count within their source: each stream checkpoint is a source of its
own, so ids that start anew never meet those of other runs.  A run counts once its
manifest row exists; partitions of a run that died before that are ignored and
overwritten when the run is repeated.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmonitor import schema
from docmonitor.operators.files import DOCUMENTS, ZIPS
from docmonitor.session import materialise

BATCH, COMPACTED = "batch", "compaction"
#: Beside the keys of a compaction: the run that brought each.
ORIGIN = (T.StructField("from_source", T.StringType()), T.StructField("from_batch", T.LongType()))


def _read_or_empty(spark: SparkSession, table_schema: T.StructType, path: str) -> DataFrame:
    try:
        return spark.read.schema(table_schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], table_schema)


# -- JSON form --------------------------------------------------------------------
def seen_from_json(objects: DataFrame) -> DataFrame:
    """State rows of ``(documents map, zips map)`` objects, which are read once for both."""
    parts = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("entries")) for kind in (DOCUMENTS, ZIPS)])
    return objects.select(F.explode(parts).alias("part")).select(
        "part.kind", F.explode("part.entries").alias("key", "entry")
    ).select("kind", "key", "entry.last_modified", "entry.last_seen", "entry.target_year")


def load_seen(spark: SparkSession, path: str, dry_run: bool = False) -> DataFrame:
    """State from JSON: one object, or lines that each hold a part of it.

    A dry run takes a missing or unreadable file, or one of which any line is unreadable,
    as an empty state, never as a part of one.  A real run fails on it: an unnoticed loss
    of the state would publish everything again.
    """
    reader = spark.read.schema(schema.SEEN_JSON).option("mode", "FAILFAST")
    if dry_run:
        marked = T.StructType([*schema.SEEN_JSON.fields, T.StructField("_broken", T.StringType())])
        reader = spark.read.schema(marked).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_broken")
    try:
        objects = reader.json(path)
        if dry_run and objects.where("_broken IS NOT NULL").head(1):
            return spark.createDataFrame([], schema.SEEN)
        return seen_from_json(objects)
    except AnalysisException as problem:
        if dry_run and problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema.SEEN)
        raise


def seen_json_lines(seen: DataFrame) -> DataFrame:
    """Each state row as a JSON object with that one entry.

    The lines together are the state; no row ever holds more than its own entry,
    and ``load_seen`` reads them like the one-object form.
    """
    entry = F.create_map("key", F.struct("last_modified", "last_seen", "target_year"))
    return seen.select(
        "kind", "key",
        F.to_json(F.struct(
            F.when(F.col("kind") == DOCUMENTS, entry).alias(DOCUMENTS),
            F.when(F.col("kind") == ZIPS, entry).alias(ZIPS),
        )).alias("value"),
    )


def export_seen_json(seen: DataFrame, path: str, run_ts: dt.datetime) -> str:
    """Write the JSON form under a name that carries the run time."""
    target = f"{path.rstrip('/')}/event_data_{run_ts:%Y%m%d_%H%M}"
    seen_json_lines(seen).select("value").write.mode("overwrite").text(target)
    return target


# -- table form -------------------------------------------------------------------
def check_source(source: str) -> str:
    """Sources become folder names."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.-]*", source) or source == COMPACTED:
        raise ValueError(f"not a name for a source of runs: {source!r}")
    return source


def committed_batches(spark: SparkSession, root: str) -> DataFrame:
    """One row per finished run."""
    return _read_or_empty(spark, schema.MANIFEST, f"{root}/manifest")


def is_committed(spark: SparkSession, root: str, batch_id: int, source: str = BATCH) -> bool:
    done = committed_batches(spark, root)
    return not done.where((F.col("batch_id") == batch_id) & (F.col("source") == source)).isEmpty()


def _last_compaction(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """The runs that the newest compaction holds, and its version (-1: none)."""
    done = _read_or_empty(spark, schema.COMPACTION, f"{root}/compactions")
    version = done.agg(F.max("version")).first()[0]
    version = -1 if version is None else version
    return done.where(F.col("version") == version).select("source", "batch_id"), version


def _state_of(spark: SparkSession, root: str, runs: DataFrame) -> DataFrame:
    """State of ``runs``, those before the newest compaction from its copy.

    The runs, one short row each, are sent to the state and prune its partitions: no state is
    shuffled for them.
    """
    covered, version = _last_compaction(spark, root)
    live = runs.select("source", "batch_id").join(covered, ["source", "batch_id"], "left_anti")
    if version >= 0:
        live = live.unionByName(spark.range(1).select(
            F.lit(COMPACTED).alias("source"), F.lit(version).cast("long").alias("batch_id")))
    table = T.StructType([
        *schema.SEEN.fields, *ORIGIN, T.StructField("source", T.StringType()), T.StructField("batch", T.LongType()),
    ])
    rows = _read_or_empty(spark, table, f"{root}/seen")
    rows = rows.join(F.broadcast(live.withColumnRenamed("batch_id", "batch")), ["source", "batch"], "left_semi")
    origin = {own.name: F.coalesce(own.name, F.col(part)) for own, part in zip(ORIGIN, ("source", "batch"))}
    return rows.withColumns(origin).drop("source", "batch")


def read_seen(spark: SparkSession, root: str) -> DataFrame:
    """State of all finished runs; partitions of unfinished ones don't count."""
    return _state_of(spark, root, committed_batches(spark, root)).select(*schema.SEEN.fieldNames())


def read_seen_as_of(spark: SparkSession, root: str, time: dt.datetime) -> DataFrame:
    """State as it was at a time: that of the runs the manifest dates no later.

    A compaction keeps beside each key the run that brought it, so it doesn't matter
    whether the state was compacted since.
    """
    runs = committed_batches(spark, root).where(F.col("run_ts") <= F.lit(time).cast("timestamp_ntz"))
    runs = materialise(runs.select("source", "batch_id"), "runs")
    covered, _ = _last_compaction(spark, root)
    rows = _state_of(spark, root, runs.unionByName(covered).distinct())
    own = runs.toDF(*(c.name for c in ORIGIN))
    return rows.join(F.broadcast(own), [c.name for c in ORIGIN], "left_semi").select(*schema.SEEN.fieldNames())


def write_progress(deltas: DataFrame, root: str, batch_id: int, source: str = BATCH) -> DataFrame:
    """Add a run's part of the archives' progress (repeatable), and read it back."""
    path = f"{root}/progress/source={source}/batch={batch_id}"
    deltas.select(*schema.PROGRESS.fieldNames()).write.mode("overwrite").parquet(path)
    return deltas.sparkSession.read.schema(schema.PROGRESS).parquet(path)


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    """Progress rows of all finished runs; their sums are the archives' progress."""
    table = T.StructType([
        *schema.PROGRESS.fields, T.StructField("source", T.StringType()), T.StructField("batch", T.LongType())])
    done = committed_batches(spark, root).select("source", F.col("batch_id").alias("batch"))
    return _read_or_empty(spark, table, f"{root}/progress").join(F.broadcast(done), ["source", "batch"], "left_semi").select(
        *schema.PROGRESS.fieldNames())


def write_seen(new: DataFrame, root: str, batch_id: int, source: str = BATCH) -> None:
    """Add the keys of one run (repeatable: overwrites only that run's folder)."""
    new.select(*schema.SEEN.fieldNames()).write.mode("overwrite").parquet(
        f"{root}/seen/source={source}/batch={batch_id}"
    )


def commit_batch(
    spark: SparkSession, root: str, batch_id: int, run_id: str | None,
    run_ts: dt.datetime, accepted: int, source: str = BATCH, dropped: dict[str, int] | None = None,
) -> None:
    """The run is done: later runs see its state from here on."""
    row = spark.createDataFrame([(source, batch_id, run_id, run_ts, accepted, dropped)], schema.MANIFEST)
    row.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/run={source}-{batch_id}")


def started_at(
    spark: SparkSession, root: str, batch_id: int, source: str, now: dt.datetime
) -> dt.datetime:
    """The time of a run, kept before its work starts, so that a replay has the same."""
    path = f"{root}/started/{source}-{batch_id}"
    known = _read_or_empty(spark, schema.STARTED, path).agg(F.min("run_ts")).first()[0]
    if known is None:
        spark.createDataFrame([(now,)], schema.STARTED).coalesce(1).write.mode("overwrite").parquet(path)
    return known or now


def compact_seen(spark: SparkSession, root: str, files: int) -> None:
    """Copy the finished state into ``files`` files hashed by key; later runs read those.

    For states of many small batches.  Everything else under ``root`` stays: batch ids, so
    replays are still skipped, publications, and the stream's checkpoint.  The copy counts
    once the list of the runs it holds is written; a run that ends meanwhile is not in that
    list and is read beside the copy.
    """
    runs = materialise(committed_batches(spark, root).select("source", "batch_id"), "runs")
    version = _last_compaction(spark, root)[1] + 1
    _state_of(spark, root, runs).repartition(files, "key").write.mode("overwrite").parquet(
        f"{root}/seen/source={COMPACTED}/batch={version}")
    runs.coalesce(1).write.mode("overwrite").parquet(f"{root}/compactions/version={version}")


# -- bucketed form ----------------------------------------------------------------
def save_seen_table(seen: DataFrame, table: str, buckets: int) -> None:
    """State as a catalog table bucketed by key.

    Anti-joins on the key then shuffle the new files only; worth it once the
    state is far beyond the broadcast size and a shared catalog exists.
    """
    seen.write.mode("append").bucketBy(buckets, "key").sortBy("key").saveAsTable(table)
