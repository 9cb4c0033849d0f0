"""Removes lines that stand on many sites, by HyperLogLog sketches of the sites per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmonitor.llm.common import read_table, row_key, under_numbers
from docmonitor.session import materialise

LEAST_SITES = 4
LEAST_WORDS = 4
LG_K = 10
BAND = 0.2  # of the threshold, on each side and one site at least: six standard errors of such sketches
NO_SITE = "\x00"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def line_rows(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``row_key, doc_id, site, pos, h1, h2`` of every line with enough words.

    Lines are compared without white space at their ends, by 128 bits of hash.  Documents
    without a source share one site.
    """
    rows = docs.select(
        row_key().alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit(NO_SITE)).alias("site"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    line = F.regexp_replace("line", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    rows = rows.withColumn("line", line).where(F.size(F.split("line", r"[\x20\x09-\x0D]+")) >= least_words)
    return rows.select("row_key", "doc_id", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def spread_lines(lines: DataFrame, least_sites: int = LEAST_SITES) -> DataFrame:
    """``h1, h2, first`` of the lines on at least ``least_sites`` different sites.

    One sketch a line, merged by partial aggregation, so a line of a third of all documents
    reaches the shuffle once a task.  An estimate clearly over or under the threshold
    decides; the lines near it get exact counts, from their distinct sites alone.
    """
    sketch = F.hll_sketch_agg("site", F.lit(LG_K))
    found = materialise(
        lines.groupBy("h1", "h2").agg(
            F.hll_sketch_estimate(sketch).alias("sites"), F.count("*").alias("n"),
            F.min(F.struct("doc_id", "row_key", "pos")).alias("first"))
        .where((F.col("n") >= least_sites) & (F.col("sites") >= least_sites - _band(least_sites))), "spread")
    sure = F.col("sites") > least_sites + _band(least_sites)
    near = found.where(~sure)
    exact = (lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
             .groupBy("h1", "h2").count().where(F.col("count") >= least_sites).select("h1", "h2"))
    return found.where(sure).select("h1", "h2", "first").unionByName(
        near.join(exact, ["h1", "h2"]).select("h1", "h2", "first"))


def _band(least_sites: int) -> float:
    return max(1.0, BAND * least_sites)


def dedupe_lines(docs: DataFrame, least_sites: int = LEAST_SITES, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with shorter texts, and ``n_lines`` and ``n_removed`` beside them.

    The first occurrence of a spread line (least ``doc_id``, then place) stays, so no text
    is lost from the corpus; shorter lines stay as they are.  A null text stays null.  Equal
    rows are treated alike.  Own columns called ``n_lines`` or ``n_removed`` are replaced.
    """
    lines = materialise(line_rows(docs, least_words), "lines")  # hashes, not texts: read three times below
    spread = materialise(spread_lines(lines, least_sites), "spread-lines")
    hits = lines.join(spread, ["h1", "h2"]).where(~(
        F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.row_key") == F.col("row_key"))
        & (F.col("first.pos") == F.col("pos"))))
    removed = hits.groupBy(F.col("row_key").alias("_key")).agg(F.collect_set("pos").alias("_removed"))  # lines of one text
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    docs, inner = under_numbers(docs.select(*(F.col(f"`{c}`") for c in own)), ("doc_id", "source", "text"))
    keyed = docs.withColumn("_row_key", row_key())
    joined = keyed.join(removed, keyed["_row_key"] == removed["_key"], "left")
    every = _lines(F.col("text"))
    left = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("_removed"))
    text = F.when(F.col("_removed").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(every, i)), "\n"))
    return joined.select(
        *(text.alias(c) if c == "text" else F.col(c) for c in inner),
        F.size(every).cast("long").alias("n_lines"), F.coalesce(F.size("_removed"), F.lit(0)).cast("long").alias("n_removed")).toDF(*own, "n_lines", "n_removed")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, removed lines and the digest of what stays, of every document."""
    out = dedupe_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


OP5_SQL = r"""
WITH a AS (SELECT doc_id, coalesce(source, chr(1)) AS site, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, site, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM a),
n AS (SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare FROM l),
w AS (SELECT * FROM n WHERE len(regexp_extract_all(bare, '[^\x20\x09-\x0D]+')) >= 4),
s AS (SELECT bare FROM w GROUP BY bare HAVING count(DISTINCT site) >= 4),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY bare ORDER BY doc_id, pos) AS k FROM w SEMI JOIN s USING (bare)),
k AS (SELECT n.doc_id, n.pos, n.line, coalesce(r.k, 1) > 1 AS gone FROM n LEFT JOIN r ON n.doc_id = r.doc_id AND n.pos = r.pos)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS text_sha256
FROM k GROUP BY doc_id
"""
