"""Centroid clustering of integer vectors by scalar lookup tables.

Vectors become integers once.  In each round a batch of vectors tabulates, for every
dimension, the squared difference of each integer that occurs there to each centroid;
a distance is then a gather from the table and a sum, with no multiplication per vector.
All is integer arithmetic, so results don't depend on the order of rows or batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmonitor.llm.common import read_table
from docmonitor.session import materialise

DIMENSIONS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
LARGEST = 1 << 27  # beyond, a squared distance of 64 dimensions may pass 64 bits
DENSE_SPAN = 1 << 16
BATCH_ROWS = 4096


def integer_vectors(rows: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v``: vectors of that length without null or non-finite components, as
    ``floor(scale * x)``; others leave.  A component beyond ``LARGEST`` stops the job, as
    distances would not fit."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    kept = rows.where((F.size(x) == dimensions) & finite)

    def scaled(c):
        whole = F.lit(float(scale)) * c
        fits = F.abs(whole) <= LARGEST
        return F.when(fits, F.floor(whole)).otherwise(F.raise_error(F.lit("vector component too large")).cast("long"))

    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, scaled).alias("v"))


def first_centroids(vectors: DataFrame, count: int = CENTROIDS) -> np.ndarray:
    """The vectors with the smallest sha256 of ``1:<vec_id>``, in that order; rows with one
    number are in the order of their components.  A null number has no hash and starts
    nothing unless too few others are there (these come last)."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    top = vectors.select(key.alias("key"), "v").orderBy(F.asc_nulls_last("key"), "v").limit(count).collect()
    return np.array([r["v"] for r in top], np.int64)


def _codes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The integers that occur, ascending, and each component's place among them."""
    low, high = int(values.min()), int(values.max())
    if high - low >= DENSE_SPAN:
        found, codes = np.unique(values, return_inverse=True)
        return found, codes.reshape(values.shape)
    occurs = np.zeros(high - low + 1, bool)
    occurs[(values - low).ravel()] = True
    place = np.cumsum(occurs) - 1
    return np.flatnonzero(occurs) + low, place[values - low]


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's centroid (ties: the smaller number) and squared distance."""
    found, codes = _codes(values)
    total = np.zeros((len(values), len(centroids)), np.int64)
    for d in range(values.shape[1]):
        table = (found[:, None] - centroids[None, :, d]) ** 2
        total += table[codes[:, d]]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(values)), best]


def _parts(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for at in range(0, batch.num_rows, BATCH_ROWS):
        part = batch.slice(at, BATCH_ROWS)
        yield part.column("vec_id"), part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Each cluster's count and componentwise sums; a task sends one row a cluster and dimension."""
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), np.int64)
        sums = np.zeros(centroids.shape, object)  # exact, however many rows
        for batch in batches:
            for _, values in _parts(batch, width):
                best, _ = nearest(values, centroids)
                part = np.zeros(centroids.shape, np.int64)
                np.add.at(part, best, values)
                sums += part
                counts += np.bincount(best, minlength=len(centroids))
        rows = [(c, d, int(counts[c]), str(sums[c, d])) for c in np.flatnonzero(counts).tolist() for d in range(width)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
            list(zip(*rows)) or [()] * 4, (pa.int32(), pa.int32(), pa.int64(), pa.string()))], names=["c", "d", "n", "s"])

    found = vectors.mapInArrow(run, "c int, d int, n long, s string").groupBy("c", "d").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # centroids x dimensions
    out = {}
    for r in found:
        out.setdefault(r["c"], (r["n"], [0] * width))[1][r["d"]] = int(r["s"])
    return out


def cluster(rows: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS,
            dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each kept vector.

    Lloyd's rounds on integers: means are floored, an empty cluster keeps its centroid.
    Null, short, long and non-finite vectors leave; repeated rows count as often as they stand
    there; with fewer vectors than centroids there are as many centroids as vectors; an empty
    table gives an empty one.  Only ``vec_id`` and ``embedding`` are read.  Tables hold
    the integers of one batch, so their size has a bound whatever the values.
    """
    spark = rows.sparkSession
    ddl = "vec_id long, cluster int, distance long"
    vectors = materialise(integer_vectors(rows, dimensions, scale), "integers")
    centroids = first_centroids(vectors, count)
    if not len(centroids):
        return spark.createDataFrame([], ddl + ", cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        for c, (n, sums) in _sums(vectors, centroids).items():
            centroids[c] = [s // n for s in sums]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, values in _parts(batch, dimensions):
                best, distance = nearest(values, centroids)
                yield pa.RecordBatch.from_arrays([ids, pa.array(best, pa.int32()), pa.array(distance)],
                                                 names=["vec_id", "cluster", "distance"])

    found = materialise(vectors.mapInArrow(assign, ddl), "assigned")
    per_cluster = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # one row a centroid
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = spark.createDataFrame([(c, s, sum(per_cluster.values()), digest[c]) for c, s in per_cluster.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(  # one row a centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_scalar_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen clusters of ``embeddings`` after three rounds."""
    return cluster(read_table(spark, sf_dir, "embeddings"))


def _sql(rounds: int = ROUNDS) -> str:
    """Rounds written out: centroids c0, c1, ..., each from the assignment to the one before."""
    nearest_to = """a{i} AS (SELECT vec_id, no, cluster, distance FROM (
  SELECT v.vec_id, v.no, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS distance FROM parts v JOIN c{i} c USING (d) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY no ORDER BY distance, cluster) = 1)"""
    means = """c{j} AS (SELECT cluster, d, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
  SELECT cluster, d, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS x
  FROM a{i} JOIN parts USING (no) GROUP BY cluster, d) m USING (cluster, d))"""
    steps = [nearest_to.format(i=0)]
    for i in range(rounds):
        steps += [means.format(i=i, j=i + 1), nearest_to.format(i=i + 1)]
    last = rounds
    return f"""WITH kept AS (SELECT row_number() OVER () AS no, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
parts AS MATERIALIZED (SELECT no, vec_id, d, CAST(floor({SCALE} * CAST(embedding[d] AS DOUBLE)) AS BIGINT) AS x
  FROM kept, (SELECT unnest(range(1, {DIMENSIONS + 1})) AS d)),
starts AS (SELECT no, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM kept
  QUALIFY cluster < {CENTROIDS}),
c0 AS (SELECT cluster, d, x FROM starts JOIN parts USING (no)),
{", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)},
inertias AS (SELECT cluster, sum(distance) AS cluster_inertia FROM a{last} GROUP BY cluster),
digests AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{last} GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(cluster_inertia AS BIGINT) AS cluster_inertia,
  CAST((SELECT sum(distance) FROM a{last}) AS BIGINT) AS inertia, centroid_sha256
FROM a{last} JOIN inertias USING (cluster) JOIN digests USING (cluster)"""


OP12_SQL = _sql()
