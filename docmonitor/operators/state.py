"""State rows of a run, upserts, and the project lookup."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmonitor import schema
from docmonitor.functions.dates import http_timestamp, iso_last_modified
from docmonitor.operators.documents import global_rank
from docmonitor.operators.files import DOCUMENTS, ZIPS


def _entries(rows: DataFrame, kind: str, key: str, run_ts: dt.datetime) -> DataFrame:
    return rows.select(
        F.lit(kind).alias("kind"),
        F.col(key).alias("key"),
        iso_last_modified(http_timestamp(F.col("publication_lastmodified"))).alias("last_modified"),
        F.lit(run_ts.isoformat(timespec="seconds")).alias("last_seen"),
        F.col("year").cast("string").alias("target_year"),
    )


def document_entries(accepted: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return _entries(accepted, DOCUMENTS, "event_data_key", run_ts)


def zip_entries(complete: DataFrame, accepted: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Entries of finished archives, dated like the archive.

    All members of an archive carry its date and year, so its row is an
    aggregate of two columns, combined before the shuffle.
    """
    archives = (
        accepted.where("file_from_zip")
        .groupBy("source_file_url")
        .agg(
            F.min("publication_lastmodified").alias("publication_lastmodified"),
            F.min("year").alias("year"),
        )
        .join(complete, F.col("source_file_url") == F.col("zip_url"), "left_semi")
    )
    return _entries(archives, ZIPS, "source_file_url", run_ts)


def _upsert(seen: DataFrame, new: DataFrame) -> DataFrame:
    """Entries of ``new`` replace those with the same kind and key."""
    old = seen.join(new.select("kind", "key"), ["kind", "key"], "left_anti")
    names = schema.SEEN.fieldNames()
    return old.select(*names).unionByName(new.select(*names))


def upsert_documents(seen: DataFrame, accepted: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return _upsert(seen, document_entries(accepted, run_ts))


def upsert_zips(
    seen: DataFrame, complete: DataFrame, accepted: DataFrame, run_ts: dt.datetime
) -> DataFrame:
    return _upsert(seen, zip_entries(complete, accepted, run_ts))


def resolve_project(requests: DataFrame, projects: DataFrame) -> DataFrame:
    """Id of each requested project: ``(project, project_ref, created)``.

    Text that parses as an integer is the id itself; other text is looked up by
    title; unknown titles get the ids after the highest known one, in title order.
    """
    asked = requests.select("project").distinct()
    asked = asked.withColumn("_id", F.expr("try_cast(trim(project) AS BIGINT)"))
    by_title = projects.groupBy(F.col("title").alias("project")).agg(F.min("id").alias("_known"))
    found = asked.join(by_title, "project", "left")
    missing = found.where("_id IS NULL AND _known IS NULL").select("project")
    highest = projects.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    created = global_rank(missing, "project").select(
        "project", (F.col("rank") + highest).alias("_new")
    )
    return found.join(created, "project", "left").select(
        "project",
        F.coalesce("_id", "_known", "_new").alias("project_ref"),
        F.col("_new").isNotNull().alias("created"),
    )
