"""From file links to document rows: headers, known files, archive members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmonitor.functions.text import file_ext
from docmonitor.functions.urls import event_key, is_zip

DOCUMENTS, ZIPS = "documents", "zips"

# Columns archive members take over from the archive's own document row.
_INHERITED = (
    "crawl_seq", "project", "category_local", "authority", "source_page_url",
    "source_file_url", "publication_lastmodified", "year", "department_label",
)


def with_headers(files: DataFrame, headers: DataFrame, on: str = "source_file_url") -> DataFrame:
    """Attach header data; the final URL replaces the link's URL."""
    kept = [c for c in files.columns if c not in (on, "publication_lastmodified")]
    return files.join(headers, F.col(on) == F.col("request_url"), "inner").select(
        *kept,
        F.col("final_url").alias(on),
        F.col("last_modified").alias("publication_lastmodified"),
    )


def headers_or_reason(files: DataFrame, headers: DataFrame, on: str = "source_file_url") -> DataFrame:
    """The same for all files: those nobody has a header of say so in ``_drop_reason``."""
    kept = [c for c in files.columns if c not in (on, "publication_lastmodified")]
    joined = files.join(headers, F.col(on) == F.col("request_url"), "left")
    return joined.select(
        *kept,
        F.coalesce("final_url", on).alias(on),
        F.col("last_modified").alias("publication_lastmodified"),
        F.when(F.col("request_url").isNull(), "No header").alias("_drop_reason"),
    )


def route_zip(files: DataFrame, on: str = "source_file_url") -> tuple[DataFrame, DataFrame]:
    """``(archives, other files)`` by final URL."""
    zipped = is_zip(F.col(on))
    return files.where(zipped), files.where(~zipped)


def not_seen(
    files: DataFrame, seen: DataFrame, on: str = "source_file_url", kinds=(DOCUMENTS, ZIPS)
) -> DataFrame:
    """Files no earlier run recorded, whatever kind they were recorded as.

    No broadcast hint: the state grows with every run, so Spark picks the join
    by measured size (``session.configure``), and shuffles both sides once the state is large.
    """
    known = seen.where(F.col("kind").isin(*kinds)).select(F.col("key").alias("_key"))
    return files.join(known, F.col(on) == F.col("_key"), "left_anti")


def not_seen_final(
    files: DataFrame, seen: DataFrame, on: str = "source_file_url"
) -> DataFrame:
    """Archives checked against known archives, other files against known documents.

    One anti-join on (kind, key) serves both branches.
    """
    known = seen.select(F.col("kind").alias("_kind"), F.col("key").alias("_key"))
    kind = F.when(is_zip(F.col(on)), F.lit(ZIPS)).otherwise(F.lit(DOCUMENTS))
    return files.join(known, (F.col(on) == F.col("_key")) & (kind == F.col("_kind")), "left_anti")


def not_seen_members(members: DataFrame, seen: DataFrame) -> DataFrame:
    """Archive members no earlier run published."""
    known = seen.where(F.col("kind") == DOCUMENTS).select(F.col("key").alias("_key"))
    key = event_key(F.lit(True), F.col("zip_url"), F.col("member_path"))
    return members.join(known, key == F.col("_key"), "left_anti")


def expand_zip_docs(zip_docs: DataFrame, members: DataFrame) -> DataFrame:
    """One document row per member, with the fields of its archive.

    An archive URL is unique in ``zip_docs``; members of one huge archive form
    one join key, which adaptive execution splits.
    """
    parents = zip_docs.select(*[c for c in _INHERITED if c in zip_docs.columns])
    rows = members.join(parents, F.col("zip_url") == F.col("source_file_url"), "inner")
    return rows.select(
        *parents.columns,
        F.lit(None).cast("string").alias("title"),
        F.lit(True).alias("file_from_zip"),
        F.substring_index("member_path", "/", -1).alias("source_filename"),
        "member_path",
    )


def as_plain_docs(files: DataFrame) -> DataFrame:
    """Files outside archives in the shape ``expand_zip_docs`` gives members."""
    return files.select(
        *[c for c in _INHERITED if c in files.columns],
        "title",
        F.lit(False).alias("file_from_zip"),
        F.lit(None).cast("string").alias("source_filename"),
        F.lit(None).cast("string").alias("member_path"),
    )


def supported_members(members: DataFrame, extensions) -> DataFrame:
    return members.where(
        file_ext(F.substring_index("member_path", "/", -1)).isin(*extensions)
    )


def zip_supported_files(members: DataFrame, extensions) -> DataFrame:
    """``(zip_url, member_path)`` of the supported files of every archive, seen or not."""
    return supported_members(members, extensions).select("zip_url", "member_path")


def progress_deltas(
    accepted: DataFrame, members: DataFrame, progress: DataFrame, seen: DataFrame, extensions
) -> DataFrame:
    """What a run adds to each archive's progress: ``(zip_url, supported, published)``.

    An archive is listed, and its members looked up in the state, only when a run touches it
    for the first time; after that a run adds the number it publishes.  Listings do not change:
    an archive with other members has another URL.
    """
    new = accepted.where("file_from_zip").groupBy(F.col("source_file_url").alias("zip_url")).agg(
        F.countDistinct("event_data_key").alias("new")
    )
    first = new.select("zip_url").join(progress.select("zip_url"), "zip_url", "left_anti")
    listed = supported_members(members, extensions).join(first, "zip_url", "left_semi").select(
        "zip_url", "member_path").distinct()
    unknown = not_seen_members(listed, seen).groupBy("zip_url").agg(F.count(F.lit(1)).alias("unknown"))
    listed = listed.groupBy("zip_url").agg(F.count(F.lit(1)).alias("listed"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return new.join(listed, "zip_url", "left").join(unknown, "zip_url", "left").select(
        "zip_url", zero("listed").alias("supported"), (F.col("new") + zero("listed") - zero("unknown")).alias("published"),
    )


def finished_zips(progress: DataFrame, touched: DataFrame) -> DataFrame:
    """Archives of ``touched`` whose supported members are all published: ``(zip_url)``."""
    sums = progress.join(touched.select("zip_url"), "zip_url", "left_semi").groupBy("zip_url").agg(
        F.sum("supported").alias("supported"), F.sum("published").alias("published")
    )
    return sums.where("supported > 0 AND supported = published").select("zip_url")


def complete_zips(
    accepted: DataFrame, members: DataFrame, seen: DataFrame, extensions
) -> DataFrame:
    """Archives finished by this run: ``(zip_url)``.

    Something of the archive was accepted now, and every supported member is a
    known document, old or new.  Members of the touched archives that neither the run nor
    the state has name the unfinished ones; the others are done.  The state is only looked
    up, on the near-unique member key, never aggregated.
    """
    inside = accepted.where("file_from_zip")
    touched = inside.select(F.col("source_file_url").alias("zip_url")).distinct()
    new = inside.select(F.col("event_data_key").alias("_key"))
    key = event_key(F.lit(True), F.col("zip_url"), F.col("member_path"))
    wanted = supported_members(members, extensions).join(touched, "zip_url", "left_semi")
    unknown = not_seen_members(wanted.join(new, key == F.col("_key"), "left_anti"), seen)
    listed = touched.join(wanted.select("zip_url"), "zip_url", "left_semi")
    return listed.join(unknown.select("zip_url"), "zip_url", "left_anti")
