"""Projects that runs have created at the publishing service.

A table that only grows, like the state: each allocation adds one partition of new titles
with their ids, which counts once its commit row exists.  So an id is given once: a repeated
allocation finds its own rows, and a later one those of all before it.  Allocations on one root
follow each other; two at a time would have to be ordered by the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmonitor import schema
from docmonitor.operators.state import resolve_project
from docmonitor.sources.state import _read_or_empty

_TABLE = T.StructType([*schema.REGISTRY.fields, T.StructField("allocation", T.LongType())])


def created_projects(spark: SparkSession, root: str) -> DataFrame:
    """``(project, project_ref, allocation)`` of all finished allocations."""
    done = _read_or_empty(spark, schema.ALLOCATIONS, f"{root}/registry/commits")
    rows = _read_or_empty(spark, _TABLE, f"{root}/registry/projects")
    return rows.join(done, "allocation", "left_semi").select(*_TABLE.fieldNames())


def allocate_projects(
    requests: DataFrame, projects: DataFrame, root: str, allocation: int
) -> DataFrame:
    """Ids of all requested projects: ``(project, project_ref, created)``.

    ``projects(id, title)`` are those of the service.  Titles neither it nor the registry
    knows get the next ids, once; ``created`` are those this allocation gave, also when it is
    repeated.
    """
    spark = requests.sparkSession
    before = created_projects(spark, root).where(F.col("allocation") != allocation)
    known = projects.select("id", "title").unionByName(
        before.select(F.col("project_ref").alias("id"), F.col("project").alias("title")))
    own = created_projects(spark, root).where(F.col("allocation") == allocation)
    done = _read_or_empty(spark, schema.ALLOCATIONS, f"{root}/registry/commits")
    if done.where(F.col("allocation") == allocation).isEmpty():
        new = resolve_project(requests, known).where("created").select("project", "project_ref")
        new.write.mode("overwrite").parquet(f"{root}/registry/projects/allocation={allocation}")
        spark.createDataFrame([(allocation,)], schema.ALLOCATIONS).coalesce(1).write.mode("overwrite").parquet(
            f"{root}/registry/commits/run={allocation}")
        own = created_projects(spark, root).where(F.col("allocation") == allocation)
    found = resolve_project(requests, known.unionByName(
        own.select(F.col("project_ref").alias("id"), F.col("project").alias("title"))))
    return found.drop("created").join(
        own.select("project", F.lit(True).alias("created")), "project", "left"
    ).withColumn("created", F.coalesce("created", F.lit(False)))
