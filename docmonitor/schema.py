"""Explicit schemas of every table the package reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


PAGES = T.StructType([T.StructField("page_id", T.LongType()), *_strings("url", "html")])

FILE_HEADERS = T.StructType(_strings("request_url", "final_url", "last_modified"))

ZIP_MEMBERS = T.StructType([
    T.StructField("zip_url", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("member_path", T.StringType()),
    T.StructField("size", T.LongType()),
])

# File rows on their way in: one per file link, with its header attached.
DOCUMENTS_IN = T.StructType([
    T.StructField("crawl_seq", T.LongType()),
    *_strings(
        "title", "project", "source_page_url", "source_file_url",
        "publication_lastmodified", "authority", "category_local", "year",
        "department_label",
    ),
])

SEEN = T.StructType(_strings("kind", "key", "last_modified", "last_seen", "target_year"))

_SEEN_MAP = T.MapType(
    T.StringType(), T.StructType(_strings("last_modified", "last_seen", "target_year"))
)
SEEN_JSON = T.StructType([
    T.StructField("documents", _SEEN_MAP),
    T.StructField("zips", _SEEN_MAP),
])

MANIFEST = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("run_ts", T.TimestampNTZType()),
    T.StructField("accepted", T.LongType()),
    T.StructField("dropped", T.MapType(T.StringType(), T.LongType())),  # rows by reason
])

# What runs have added to archives: members they should hold, and members published.
PROGRESS = T.StructType([
    T.StructField("zip_url", T.StringType()),
    T.StructField("supported", T.LongType()),
    T.StructField("published", T.LongType()),
])

LOST = T.StructType(_strings("url", "reason"))

REGISTRY = T.StructType([
    T.StructField("project", T.StringType()),
    T.StructField("project_ref", T.LongType()),
])
ALLOCATIONS = T.StructType([T.StructField("allocation", T.LongType())])

STARTED = T.StructType([T.StructField("run_ts", T.TimestampNTZType())])

COMPACTION = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("version", T.LongType()),
])

# Columns of the CSV feed, in order.
FEED_COLUMNS = (
    "title", "project", "project_id", "authority", "category", "category_local",
    "source_scraper", "source_file_url", "source_filename", "source_page_url",
    "publication_date", "publication_time", "publication_datetime",
    "publication_datetime_dcformat", "publication_lastmodified", "year",
    "file_from_zip", "event_data_key", "source_file_zip_path", "departments",
    "departments_sources", "department_from_scraper",
)
