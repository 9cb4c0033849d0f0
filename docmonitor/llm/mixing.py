"""Mixing sources to target weights by pivotal dependent rounding, in native column functions.

A source that is to give a share of its words gives each document that share as copies:
a whole number, and a probability for one more.  Two documents with open probabilities
meet, words move from one to the other until one of the two is whole (0 or 1), and which
way they move is drawn so that expectations hold.  The words promised by a source stay the
same in every step, so only the last open document of a source leaves a difference, of less
than its own size.

Documents meet in small chunks of one source and of about one size (the chunk is drawn from
a hash, so a hot source has many), each leaving at most one open document; those meet in
chunks of their own, level after level: a reduction tree whose depth is the logarithm of
the largest source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmonitor.llm.common import read_table, row_key
from docmonitor.session import materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
CHUNK = 48
SEED = 17


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """Targets of sources: ``source, weight, source_size`` in, ``target`` added.

    Words are shared by weight; a source stops at ``most`` times its size, and what it can't
    take is shared by weight among the rest.  So all open sources get one number of words
    per weight.  Ordered by how soon they stop, the first that needn't stop tells that
    number.  One row a source: a list of sources with weights is as short as a mix's
    configuration, and nothing of the documents comes here but sums.
    """
    order = Window.orderBy(F.col("_limit"), F.asc_nulls_last("source"))
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    rows = sizes.withColumn("_limit", most * F.col("source_size") / F.col("weight"))
    rows = rows.withColumns({
        "_total": share * F.sum("source_size").over(whole),
        "_taken": F.coalesce(F.sum(most * F.col("source_size")).over(before), F.lit(0)),
        "_weights": F.sum("weight").over(rest)})
    level = (F.col("_total") - F.col("_taken")) / F.col("_weights")
    rows = rows.withColumn("_level", F.min(F.when(level <= F.col("_limit"), F.struct("_limit", level.alias("level")))).over(whole)["level"])
    full = (most * F.col("source_size")).cast("double")
    return rows.withColumn("target", F.coalesce(F.least(full, F.col("_level") * F.col("weight")), full)).drop(
        "_limit", "_total", "_taken", "_weights", "_level")


def _settle(items: Column, level: int, key: str) -> Column:
    """Lets a chunk's documents meet in turn: an array of ``(id, size, p, copies)`` in, with ids
    of type ``key`` and ``p`` open or whole, out ``done`` (whole) and ``open`` (at most one)."""
    entry = f"struct<_id:{key},size:bigint,p:double,copies:bigint>"
    start = F.struct(F.array().cast(f"array<{entry}>").alias("done"), F.lit(None).cast(entry).alias("open"))
    eps = F.lit(1e-12)

    def changed(item: Column, p: Column) -> Column:
        return F.struct(item["_id"].alias("_id"), item["size"].alias("size"), p.alias("p"), item["copies"].alias("copies"))

    def whole(p: Column) -> Column:
        return (p <= eps) | (p >= 1 - eps)

    def meet(acc: Column, b: Column) -> Column:
        a = acc["open"]
        # words that can move from a to b, and from b to a
        to_b = F.least(a["size"] * a["p"], b["size"] * (1 - b["p"]))
        to_a = F.least(b["size"] * b["p"], a["size"] * (1 - a["p"]))
        draw = (F.pmod(F.xxhash64(a["_id"], b["_id"], F.lit(SEED + level)), F.lit(1 << 30)) / F.lit(float(1 << 30)))
        move = F.when(draw * (to_a + to_b) < to_a, to_b).otherwise(-to_a)
        pa, pb = a["p"] - move / a["size"], b["p"] + move / b["size"]
        a2, b2 = changed(a, F.when(whole(pa), F.round(pa)).otherwise(pa)), changed(b, F.when(whole(pb), F.round(pb)).otherwise(pb))
        ends = F.filter(F.array(a2, b2), lambda x: whole(x["p"]))
        opens = F.filter(F.array(a2, b2), lambda x: ~whole(x["p"]))
        met = F.struct(F.concat(acc["done"], ends).alias("done"), F.get(opens, F.lit(0)).alias("open"))
        return (F.when(whole(b["p"]), F.struct(F.concat(acc["done"], F.array(b)).alias("done"), a.alias("open")))
                .when(a.isNull(), F.struct(acc["done"].alias("done"), b.alias("open"))).otherwise(met))

    return F.aggregate(items, start, meet)


def copies_of(sized: DataFrame, targets: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Copies to take of each document: ``row_key, source, size`` and ``targets`` in.

    ``row_key`` (of any type that can be sorted) tells rows apart and stays the same in reruns.  The result has
    ``row_key, source, size, copies``.  Documents of size 0 and of sources with target 0
    get none.
    """
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = targets.select("source", ratio.alias("_ratio"), "n_rows")
    rows = sized.join(plan, sized["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    floor = F.when(F.col("size") > 0, F.floor(F.col("_ratio") + 1e-12)).otherwise(0)
    level = rows.select(
        F.col("row_key").alias("_id"), "source", "size", "n_rows", floor.cast("long").alias("copies"),
        F.when(F.col("size") > 0, F.greatest(F.lit(0.0), F.col("_ratio") - floor)).otherwise(0.0).alias("p"))
    key = sized.schema["row_key"].dataType.simpleString()
    largest = targets.agg(F.max("n_rows")).first()[0] or 0
    done, depth = [], 0
    while True:
        # size classes only on the leaves: similar documents meet first
        kind = F.floor(F.log2(F.col("size") + 1)).cast("int") if depth == 0 else F.lit(0)
        parts = F.greatest(F.lit(1), F.ceil(F.col("n_rows") / (chunk * (chunk // 2) ** depth))).cast("long")
        part = F.pmod(F.xxhash64("_id", F.lit(depth)), parts)
        chunks = (level.withColumns({"_kind": kind, "_part": part}).groupBy("source", "_kind", "_part")
                  .agg(F.first("n_rows").alias("n_rows"),
                       F.sort_array(F.collect_list(F.struct("_id", "size", "p", "copies"))).alias("items")))
        met = materialise(chunks.select("source", "n_rows", _settle(F.col("items"), depth, key).alias("met")), "mix")
        done.append(met.select("source", F.explode("met.done").alias("d")).select("source", "d.*"))
        level = met.where("met.open IS NOT NULL").select("source", "n_rows", "met.open.*")
        depth += 1
        if largest <= chunk * (chunk // 2) ** (depth - 1) and depth > 1:
            break
    # one open document a source is left; it is drawn
    last = F.when(F.pmod(F.xxhash64("_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30)) < F.col("p"), 1.0).otherwise(0.0)
    done.append(level.select("source", "_id", "size", last.alias("p"), "copies"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(F.col("_id").alias("row_key"), "source", "size", (F.col("copies") + F.col("p").cast("long")).alias("copies"))


def ranked_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Weights by the sources' order by code point, null last, repeating."""
    place = (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1))


def size_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size`` and a ``row_key`` from number, source and text."""
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        F.coalesce(word_count(F.col("text")), F.lit(0)).alias("size"),
                        row_key().alias("row_key"))
    return sized


def mix(sized: DataFrame, weights=ranked_weights) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every document.

    Equal rows (same number, source and text) share a key: they are settled as one document
    as large as all of them, and each gets its copies.  Null sources are one source.  An
    empty table gives an empty result.
    """
    sized = materialise(sized, "mix-sizes")
    keyed = sized.groupBy("row_key", "source").agg(F.sum("size").alias("size"))
    per_source = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    targets = materialise(source_targets(weights(per_source)), "mix-targets")
    copies = copies_of(keyed, targets).select("row_key", F.col("source").alias("_source"), "copies")
    out = (sized.join(copies, (sized["row_key"] == copies["row_key"]) & sized["source"].eqNullSafe(copies["_source"]), "inner")
           .drop(copies["row_key"]).drop("_source"))
    plan = targets.select(F.col("source").alias("_source"), "source_size", "target")
    out = out.join(plan, out["source"].eqNullSafe(plan["_source"])).drop("_source")
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixes all ``documents``: how many words of each the mix takes."""
    mixed = mix(size_documents(read_table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")
