"""Reference tables (fixed size, at most 104 rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docmonitor import reference_data as ref


def dim_departments(spark: SparkSession) -> DataFrame:
    rows = [(i, name, code) for i, (name, code) in enumerate(ref.DEPARTMENTS.items())]
    return spark.createDataFrame(rows, "ord int, name string, code string")


def dim_authority(spark: SparkSession) -> DataFrame:
    rows = [(i, name, code) for i, (name, code) in enumerate(ref.AUTHORITIES.items())]
    return spark.createDataFrame(rows, "ord int, keyword string, code string")


def dim_regions(spark: SparkSession) -> DataFrame:
    rows = [(i, name, codes) for i, (name, codes) in enumerate(ref.REGIONS.items())]
    return spark.createDataFrame(rows, "ord int, name string, codes array<string>")
