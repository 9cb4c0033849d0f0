"""Publish records, the CSV feed and the run report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmonitor import reference_data as ref
from docmonitor import schema
from docmonitor.functions.text import original_ext
from docmonitor.operators.documents import DROP
from docmonitor.params import RunParams

ITEM_SEPARATOR = "\n\n"
# Lines of a report item, in order.
_REPORT_FIELDS = (
    "title", "project", "authority", "category", "category_local", "year",
    "publication_date", "source_filename", "source_file_url", "source_page_url",
    "event_data_key",
)


def data_payload(params: RunParams) -> Column:
    """Metadata kept with each document; null members vanish in ``to_json``."""
    tagged = (F.size("departments") > 0) & (F.size("departments_sources") > 0)
    return F.struct(
        F.col("authority"), F.col("category"), F.col("category_local"),
        F.col("event_data_key"),
        F.lit(params.scraper_name).alias("source_scraper"),
        F.col("year").cast("string").alias("source_scraper_year"),
        F.col("source_file_url"), F.col("source_filename"), F.col("source_page_url"),
        F.col("publication_date"), F.col("publication_time"),
        F.col("publication_datetime"), F.col("project_id"),
        F.col("source_file_zip_path"),
        F.when(tagged, F.col("departments")).alias("departments"),
        F.when(tagged, F.col("departments_sources")).alias("departments_sources"),
    )


def to_publish_records(docs: DataFrame, params: RunParams) -> DataFrame:
    """What is published of each document."""
    location = F.when(
        F.col("file_from_zip"), F.col("source_file_zip_path")
    ).otherwise(F.col("source_file_url"))
    return docs.select(
        "crawl_seq",
        location.alias("file_path"),
        original_ext(F.col("source_filename")).alias("original_extension"),
        F.lit(str(params.project)).alias("project"),
        "title",
        F.col("project").alias("description"),
        F.col("publication_datetime_dcformat").alias("publish_at"),
        F.lit(params.source_host).alias("source"),
        F.lit(params.language).alias("language"),
        F.lit(params.access_level).alias("access"),
        F.to_json(data_payload(params)).alias("data"),
        "year",
    )


def items_feed(docs: DataFrame) -> DataFrame:
    """Flat columns of the CSV feed; lists become comma-joined text."""
    return docs.select(*[
        F.array_join(c, ",").alias(c) if c in ("departments", "departments_sources") else F.col(c)
        for c in schema.FEED_COLUMNS
    ])


def year_label(first: Column, last: Column) -> Column:
    """Column form of ``RunParams.year_label``."""
    return F.when(first == last, first.cast("string")).otherwise(F.concat_ws("-", first, last))


def report_items(docs: DataFrame) -> DataFrame:
    """Report text of each document: ``(crawl_seq, member_path, item_text)``."""
    lines = [
        F.concat(F.lit(f"            {name}: "), F.coalesce(F.col(name).cast("string"), F.lit("")))
        for name in _REPORT_FIELDS
    ]
    text = F.concat(F.lit("\n"), F.concat_ws("\n", *lines), F.lit("\n            "))
    return docs.select("crawl_seq", "member_path", text.alias("item_text"))


def run_report(docs: DataFrame, params: RunParams) -> DataFrame:
    """Subject and opening lines of the report, one row.

    The items follow it as rows of ``report_items``: a run may accept more
    documents than one text value can hold, and none is left out.
    """
    count = F.col("n_items").cast("string")
    return docs.agg(F.count(F.lit(1)).alias("n_items")).select(
        F.concat(
            F.lit(f"{params.scraper_name} {params.year_label} (New: "), count,
            F.lit(f") [{params.run_name}]"),
        ).alias("subject"),
        F.concat(
            F.lit(f"{params.scraper_name} Run {params.run_id}{ITEM_SEPARATOR}SCRAPED ITEMS ("),
            count, F.lit(")"),
        ).alias("heading"),
        "n_items",
    )


def run_counts(seen: DataFrame, docs: DataFrame) -> DataFrame:
    """Documents and archives in the state, and new documents: ``(name, n)``."""
    known = seen.groupBy(F.col("kind").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    new = docs.agg(F.count(F.lit(1)).alias("n")).select(F.lit("new").alias("name"), "n")
    return known.unionByName(new)


def drop_counts(rows: DataFrame) -> DataFrame:
    """Dropped rows per reason; limit drops are expected, hence quiet."""
    return (
        rows.where(F.col(DROP).isNotNull())
        .groupBy(F.col(DROP).alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("quiet", F.col("reason") == ref.REASON_LIMIT)
    )
