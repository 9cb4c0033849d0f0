"""Nearest neighbours by an inverted multi-index.

Each half of a vector is quantised on its own, so two short lists of centroids make a grid
of cells.  A query walks the grid in order of the summed distances of its halves to the
cells' centroids, with a heap over the two sorted lists, until the cells walked hold enough
vectors; those are ranked by exact distance.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmonitor.llm.common import read_table
from docmonitor.session import materialise

K = 10
SAMPLE = 20_000
MOST_CENTROIDS = 256
LEAST_SEEN = 40 * K
SEEN_SHARE = 0.3
CHUNK = 8_192
QUERY_BLOCK = 64
CHUNK_QUERIES = 16_384


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: vectors without null or non-finite components that aren't zero, of the
    commonest length.  A null ``vec_id`` takes no part."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (length["n"] if length else 0))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """``vid, v, ids``: each different vector once, with its ``keep`` smallest numbers.

    Copies are equally near to everything and ties go to the smaller number, so no more of
    them can ever be among the nearest: a vector of a third of all rows is one candidate.
    The numbers are cut in each task before the shuffle.
    """
    hashed = rows.withColumn("h", F.xxhash64("v"))
    ranked = hashed.withColumn("r", F.row_number().over(Window.partitionBy("h", "v").orderBy("vec_id"))).where(F.col("r") <= keep)
    return ranked.groupBy("h", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.get("ids", F.lit(0)).alias("vid"), "v", "ids")


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, c)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        full = n > 0
        c[full] = sums[full] / n[full, None]
        if not full.all():
            c[~full] = x[rng.choice(len(x), int((~full).sum()))]
    return c


def square_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :]


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([np.argmin(square_distances(x[i:i + 4096], c), axis=1) for i in range(0, len(x), 4096)] or [np.zeros(0, int)])


def walk(d1: np.ndarray, d2: np.ndarray, counts: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """Cells in order of summed distance, until they hold ``enough`` vectors."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    heap, pushed, seen, cells = [(s1[0] + s2[0], 0, 0)], {(0, 0)}, 0, []
    while heap and seen < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(o1[i]), int(o2[j])
        if counts[cell]:
            cells.append(cell)
            seen += int(counts[cell])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(s1) and b < len(s2) and (a, b) not in pushed:
                pushed.add((a, b))
                heapq.heappush(heap, (s1[a] + s2[b], a, b))
    return cells


def search(vectors: DataFrame, is_query, k: int = K, least_seen: int = LEAST_SEEN, share: float = SEEN_SHARE,
           sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found of every query.

    Centroids are fitted on at most ``sample`` vectors, those with the least hash; every
    vector is indexed.  A query sees at least ``least_seen`` different vectors, and at least
    ``share`` of all: without structure in the vectors, fewer can't hold nine of the ten
    nearest.  The cells of a first half are cut into chunks, so full cells meet their queries
    in many tasks, the queries in blocks, so no task holds more than a block of queries and a
    chunk of vectors; each chunk returns ``k + 1`` candidates a query.  Repeated rows count
    once; a number with several vectors has each of them.  Where nothing is valid, the
    result is empty.
    """
    rows = materialise(valid_vectors(vectors), "vectors")
    spark = rows.sparkSession
    distinct = materialise(distinct_vectors(rows.dropDuplicates(["vec_id", "v"]), k + 1), "distinct-vectors")
    total = distinct.count()
    out_schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], out_schema)
    fitted = np.array([r["v"] for r in distinct.orderBy(F.xxhash64("vid"), "vid").limit(sample).select("v").collect()])
    half = max(1, fitted.shape[1] // 2)
    size = max(1, min(MOST_CENTROIDS, len(fitted) // 4))
    parts = fitted[:, :half], fitted[:, half:]
    centroids = spark.sparkContext.broadcast([kmeans(p, size if p.shape[1] else 1) for p in parts])  # 256 rows a half

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c1, c2 = centroids.value
        for pdf in batches:
            if len(pdf):
                x = np.array(pdf["v"].tolist())
                yield pdf.assign(c1=nearest(x[:, :half], c1), c2=nearest(x[:, half:], c2))

    placed = materialise(distinct.mapInPandas(assign, "vid long, v array<double>, ids array<long>, c1 int, c2 int"), "placed")
    counts = np.zeros((len(centroids.value[0]), len(centroids.value[1])), np.int64)
    for r in placed.groupBy("c1", "c2").count().collect():  # 65,536 cells at most
        counts[r["c1"], r["c2"]] = r["count"]
    grid = spark.sparkContext.broadcast(counts)
    enough = max(least_seen, int(share * total))

    def chunks() -> np.ndarray:
        return np.maximum(1, -(-grid.value.sum(axis=1) // CHUNK))

    queries = materialise(rows.where(is_query).groupBy(F.xxhash64("v").alias("h"), "v").agg(F.min("vec_id").alias("qid"))
                          .select("qid", "v"), "queries")

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c1, c2 = centroids.value
        n = chunks()
        for pdf in batches:
            for start in range(0, len(pdf), QUERY_BLOCK):
                part = pdf.iloc[start:start + QUERY_BLOCK]
                x = np.array(part["v"].tolist())
                d1, d2 = square_distances(x[:, :half], c1), square_distances(x[:, half:], c2)
                out = []
                for i, (q, v) in enumerate(zip(part["qid"], part["v"])):
                    cells: dict[int, list[int]] = {}
                    for a, b in walk(d1[i], d2[i], grid.value, enough):
                        cells.setdefault(a, []).append(b)
                    out += [(q, v, a, c, bs) for a, bs in cells.items() for c in range(n[a])]
                yield pd.DataFrame(out, columns=["qid", "v", "c1", "chunk", "c2s"])

    n_queries = queries.count()
    blocks = max(1, -(-n_queries // CHUNK_QUERIES))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = chunks()
        for pdf in batches:
            mixed = pdf["vid"].to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            yield pdf.assign(chunk=mixed.astype(np.int64) % n[pdf["c1"]])

    probes = queries.repartition(max(1, -(-n_queries // QUERY_BLOCK))).mapInPandas(probe, "qid long, v array<double>, c1 int, chunk int, c2s array<int>")
    probes = probes.withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int"))
    members = placed.select("vid", "v", "c1", "c2").mapInPandas(cut, "vid long, v array<double>, c1 int, c2 int, chunk int")
    members = members.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def rank(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Exact distances of each query to the members of its cells."""
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(left) and len(right):
            x, ids, cell = np.array(right["v"].tolist()), right["vid"].to_numpy(), right["c2"].to_numpy()
            for q, v, c2s in zip(left["qid"], left["v"], left["c2s"]):
                at = np.flatnonzero(np.isin(cell, c2s))
                d = np.sqrt(((x[at] - v) ** 2).sum(axis=1))
                best = _least(d, ids[at], k + 1)
                parts.append((np.full(len(best), q), ids[at][best], d[best]))
        return pd.DataFrame({name: np.concatenate(c) for name, c in zip(("qid", "vid", "score"), zip(*parts))})

    keys = ["c1", "chunk", "block"]
    found = probes.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInPandas(rank, "qid long, vid long, score double")
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy("score", "vid"))).where(F.col("r") <= k + 1).drop("r")
    near = materialise(best.join(distinct.select("vid", "ids"), "vid").select("qid", "score", F.explode("ids").alias("vec_id")), "near")
    # back to all queries with this vector: its own number doesn't count
    asked = rows.where(is_query).dropDuplicates(["vec_id", "v"]).select(F.col("vec_id").alias("query_id"), "v")
    first = queries.select("qid", F.col("v").alias("qv"))
    named = asked.join(first, asked["v"] == first["qv"]).select("query_id", "qid")
    few = near.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy("score", "vec_id"))).where(F.col("r") <= k + 1).drop("r")
    ranked = named.join(few, "qid").where("query_id <> vec_id").withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _least(d: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` least, ties by number."""
    if len(d) <= n:
        return np.lexsort((ids, d))
    limit = np.partition(d, n - 1)[n - 1]
    at = np.flatnonzero(d <= limit)
    return at[np.lexsort((ids[at], d[at]))[:n]]


def op9_multi_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth of ``embeddings``."""
    return search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
