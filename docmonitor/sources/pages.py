"""Captured pages, file headers and archives."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmonitor import schema
from docmonitor.functions.archives import zip_listing
from docmonitor.operators.files import ZIPS


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.PAGES).parquet(path)


def stream_pages(
    spark: SparkSession, path: str, table_schema: T.StructType = schema.PAGES, **options
) -> DataFrame:
    """Pages as they arrive in a folder (file stream)."""
    return spark.readStream.schema(table_schema).options(**options).parquet(path)


def read_file_headers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.FILE_HEADERS).parquet(path)


def headers_of_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Header rows of files that lie on a shared file system; contents stay unread."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select(
        F.col("path").alias("request_url"),
        F.col("path").alias("final_url"),
        F.date_format("modificationTime", "EEE, dd MMM yyyy HH:mm:ss 'GMT'").alias("last_modified"),
    )


def _archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[zZ][iI][pP]")
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def read_zips(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(zip_url, content)`` of every archive under ``path``."""
    return _archives(spark, path).select(F.col("path").alias("zip_url"), "content")


def fresh_zips(spark: SparkSession, path: str, seen: DataFrame) -> DataFrame:
    """``(zip_url, content)`` of the archives under ``path`` that the state doesn't have.

    Archives are listed first, by path alone, and only what is left after the anti-join with
    the state is opened.  The paths of new archives pass the driver, which any listing of
    files does too.
    """
    listed = _archives(spark, path).select(F.col("path").alias("zip_url"))
    known = seen.where(F.col("kind") == ZIPS).select(F.col("key").alias("zip_url"))
    new = [_literal(r["zip_url"]) for r in listed.join(known, "zip_url", "left_anti").toLocalIterator()]
    if not new:
        return spark.createDataFrame([], "zip_url string, content binary")
    return read_zips(spark, new)


def _literal(path: str) -> str:
    """A path whose special characters stand for themselves."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _listed(zips: DataFrame) -> DataFrame:
    return zips.select("zip_url", zip_listing("content").alias("listing"))


def zip_members(zips: DataFrame) -> DataFrame:
    """One row per regular file of each archive.

    Archive bytes stay in the scanning task; only paths and sizes leave it.
    """
    return _listed(zips).select("zip_url", F.inline("listing.members"))


def unreadable_zips(zips: DataFrame) -> DataFrame:
    """Archives that cannot be listed, with the reason."""
    return _listed(zips).where("listing.error IS NOT NULL").select(
        "zip_url", F.col("listing.error").alias("error")
    )
