"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
PLANNED_BROADCAST, MEASURED_BROADCAST = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"


def configure(spark: SparkSession) -> SparkSession:
    """Settings every job here relies on; all are session-level SQL settings.

    Publication dates are formatted in UTC.  Adaptive execution sizes shuffle
    partitions from real map output, turns sort-merge joins into broadcast joins
    only when the measured side is small, and splits skewed join partitions.
    No join is planned as a broadcast for its files' size: a few compressed megabytes of
    state are a gigabyte of keys on the driver.  The session's bound holds for measured rows.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    bound = spark.conf.get(PLANNED_BROADCAST)
    if not bound.startswith("-"):  # else set before, or broadcasts aren't wanted
        if spark.conf.get(MEASURED_BROADCAST, None) is None:
            spark.conf.set(MEASURED_BROADCAST, bound)
        spark.conf.set(PLANNED_BROADCAST, "-1")
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone!r}")


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; there is no other."""
    root = spark.conf.get(CHECKPOINT_CONF, "") or ""
    if not root:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/{app}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, *partition_by: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder (with a writer's ``options``) and read it back.

    Cuts the lineage of iterative plans and keeps costly results (parsed html)
    through the loss of any executor.  Unlike a checkpoint the plan runs once,
    the copy is columnar, and its size is known to later joins.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
