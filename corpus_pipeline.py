"""From raw documents to packed sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; all
but the last return the columns they got.  Missing columns that a stage needs but can do
without (``source``, ``lang``) are taken as null; extra columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmonitor.llm.common import read_table, row_key, small_batches, tokenizer_path, under_numbers
from docmonitor.llm.line_dedup import dedupe_lines
from docmonitor.llm.mixing import mix, size_documents
from docmonitor.llm.packing import pack, token_pieces
from docmonitor.llm.quality_rules import judge
from docmonitor.llm.token_groups import near_components
from docmonitor.session import materialise


def carrying(stage: Callable) -> Callable:
    """A stage that sees the columns of documents alone under their names, and gives all
    columns back as they came, whatever they are called."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rows, inner = under_numbers(docs, ("doc_id", "text", "lang", "source", "n_chars"), ("lang", "source"))
        return stage(spark, rows, sf_dir).select(*inner).toDF(*docs.columns)

    return run


@carrying
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that pass the quality rules."""
    small_batches(spark)
    return judge(docs, keep_columns=True).where("kept")


@carrying
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that stand on many sites but at their first place; documents of
    which no word is left go, and ``n_chars`` follows the text."""
    small_batches(spark)
    out = dedupe_lines(docs)
    emptied = (F.col("n_removed") > 0) & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    out = out.where(~emptied)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return out


@carrying
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (5-word shingles, Jaccard 0.8): the
    one with the least number, of equal rows one.  Documents without words all stay."""
    small_batches(spark)
    found = materialise(near_components(docs, size=5, percent=80), "near")
    with_words = found.where("n_shingles > 0").withColumn(
        "_first", F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row_key"))
    first = with_words.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("row_key")).alias("_alone")).agg(
        F.min("_first").alias("_first"))
    keep = first.select(F.col("_first.row_key").alias("_key"), F.lit(True).alias("_one")).unionByName(
        found.where("n_shingles = 0").select(F.col("row_key").alias("_key"), F.lit(False).alias("_one"))).distinct()
    keyed = docs.withColumn("_row_key", row_key())
    kept = keyed.join(keep, keyed["_row_key"] == keep["_key"])
    # a limit by rank, so that rows repeated in full are cut in each task before they meet
    place = F.row_number().over(Window.partitionBy("_row_key").orderBy("doc_id"))
    one = kept.where("_one").withColumn("_place", place).where("_place = 1").drop("_place")
    return one.unionByName(kept.where("NOT _one"))


@carrying
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it; those it doesn't take, and those
    without words, go."""
    mixed = mix(size_documents(docs)).groupBy("row_key").agg(F.max("copies").alias("_copies")).where("_copies > 0")
    keyed = docs.withColumn("_row_key", row_key())
    taken = keyed.join(mixed, keyed["_row_key"] == mixed["row_key"])
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 2048 tokens."""
    small_batches(spark)
    return pack(token_pieces(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: The mix draws by hash and the packing counts tokens, which SQL doesn't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
