"""Cleaning, classifying, tagging and limiting document rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmonitor import reference_data as ref
from docmonitor.functions import dates, departments, text, urls
from docmonitor.params import RunParams
from docmonitor.session import materialise

DROP = "_drop_reason"
#: Every reason a row may be dropped for, from the page it was linked on to the limit.
REASONS = (
    "Page not captured", "No year", "No link text", "No header", "No department code", "Bad Last-Modified",
    "No category", "No file URL", "Empty project", "Empty title", "No authority", "No page URL",
    ref.REASON_UNSUPPORTED, ref.REASON_LIMIT,
)


#: A limit's rows a range: only the range that holds its last one is sorted, in one place.
ROWS_PER_RANGE = 1_000_000


def parse_http_date(df: DataFrame) -> DataFrame:
    """Publication date columns from the Last-Modified text; null when malformed."""
    ts = F.col("publication_ts")
    return (
        df.withColumn("publication_ts", dates.http_timestamp(F.col("publication_lastmodified")))
        .withColumns({
            "publication_date": dates.publication_date(ts),
            "publication_time": dates.publication_time(ts),
            "publication_datetime": dates.publication_datetime(ts),
            "publication_datetime_dcformat": dates.publication_datetime_dcformat(ts),
        })
    )


def categorize(df: DataFrame) -> DataFrame:
    return df.withColumn("category", text.category(F.col("category_local")))


def source_filename(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "source_filename",
        urls.source_filename(F.col("source_filename"), F.col("source_file_url")),
    )


def _raw_title() -> Column:
    return F.when(F.col("file_from_zip"), text.zip_title(F.col("member_path"))).otherwise(
        F.col("title")
    )


def beautify(df: DataFrame) -> DataFrame:
    """Project and title clean-up; members of archives are titled by their path."""
    return df.withColumns({
        "project": text.clean_project(F.col("project")),
        "title": text.clean_title(_raw_title()),
    })


def project_id(df: DataFrame) -> DataFrame:
    joined = F.concat(F.col("source_page_url"), F.lit(" "), F.col("project"))
    return df.withColumn("project_id", F.sha2(joined, 256))


def event_key(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "event_data_key": urls.event_key(
            F.col("file_from_zip"), F.col("source_file_url"), F.col("member_path")
        ),
        "source_file_zip_path": F.when(F.col("file_from_zip"), F.col("member_path")),
    })


def with_constants(df: DataFrame, params: RunParams) -> DataFrame:
    """Values every document of a run shares."""
    return df.withColumns({
        "authority": F.lit(params.authority),
        "category_local": F.lit(params.category_local),
        "source_scraper": F.lit(params.source_scraper),
    })


def tag_departments(df: DataFrame) -> DataFrame:
    """Departments and where they come from.

    Starts from the page's code.  An authority that names another department
    settles the matter; else the project name is searched: numbers, then names,
    then regions, each step only for the rows the previous one left empty.
    Staged columns keep every pattern evaluated at most once a row.
    """
    page_code = F.col("department_from_scraper")
    by_authority = departments.dept_from_authority(F.col("authority"))
    project = F.col("project")
    nothing = F.array().cast("array<string>")
    staged = df.withColumn("_authority", by_authority).withColumn(
        "_other", (F.col("_authority") != "") & (F.col("_authority") != page_code)
    )
    staged = staged.withColumn(
        "_codes", F.when(~F.col("_other"), departments.dept_numbers(project)).otherwise(nothing)
    )
    open_ = ~F.col("_other") & (F.size("_codes") == 0)
    for search in (departments.dept_names, departments.dept_regions):
        staged = staged.withColumn(
            "_codes", F.when(open_, search(project)).otherwise(F.col("_codes"))
        )
    staged = staged.withColumn("_codes", departments.sorted_codes(F.col("_codes")))
    by_name = (F.size("_codes") > 0) & (F.col("_codes") != F.array(page_code))
    return staged.withColumns({
        "departments": departments.sorted_codes(
            F.when(F.col("_other"), F.array(page_code, F.col("_authority")))
            .when(by_name, F.concat(F.array(page_code), F.col("_codes")))
            .otherwise(F.array(page_code))
        ),
        "departments_sources": F.when(
            F.col("_other"), F.array(F.lit("scraper"), F.lit("authority"))
        ).when(by_name, F.array(F.lit("scraper"), F.lit("regex")))
        .otherwise(F.array(F.lit("scraper"))),
    }).drop("_authority", "_other", "_codes")


# -- dropped rows: a reason column, never a second pass ------------------------------
def _set_reason(df: DataFrame, *rules: tuple[Column, str]) -> DataFrame:
    """First rule that holds names the reason; earlier reasons stay."""
    reason = F.col(DROP) if DROP in df.columns else F.lit(None).cast("string")
    found = F.lit(None).cast("string")
    for test, name in reversed(rules):
        found = F.when(test, F.lit(name)).otherwise(found)
    return df.withColumn(DROP, F.coalesce(reason, found))


def quarantine(df: DataFrame) -> DataFrame:
    """Mark rows that cannot become a document, before the limit counts them.

    Looks at rows as they came in (before ``source_filename`` and ``beautify``):
    each test is a cheap equivalent of "comes out empty", so filtering on the
    reason does not pull the whole clean-up into the filter.
    """
    url = F.coalesce(F.nullif("source_filename", F.lit("")), F.col("source_file_url"))
    return _set_reason(
        df,
        (departments.department_code(F.col("department_label")).isNull(), "No department code"),
        (dates.http_timestamp(F.col("publication_lastmodified")).isNull(), "Bad Last-Modified"),
        (F.col("category_local").isNull(), "No category"),
        (url.isNull(), "No file URL"),
        (text.blank_project(F.col("project")), "Empty project"),
        (text.blank_title(_raw_title()), "Empty title"),
        (F.col("authority").isNull(), "No authority"),
    )


def quarantine_late(df: DataFrame) -> DataFrame:
    """Mark rows found unpublishable only after the limit counted them."""
    return _set_reason(
        df,
        (F.col("source_page_url").isNull(), "No page URL"),
        (text.category(F.col("category_local")).isNull(), "No category"),
    )


def supported_only(df: DataFrame, extensions) -> DataFrame:
    """Mark files of other types, by given file name or else by URL."""
    filename = urls.source_filename(F.col("source_filename"), F.col("source_file_url"))
    unsupported = ~text.file_ext(filename).isin(*extensions)
    return _set_reason(df, (unsupported, ref.REASON_UNSUPPORTED))


def _nth_key(rows: DataFrame, n: int, order: list[str]) -> Column:
    """Scalar: the n-th smallest order key, the largest one if there are fewer.

    The keys are range-partitioned and written; counts, one number a range, tell which
    range holds the n-th, and only that one is sorted.
    """
    placed = _in_ranges(rows.select(*order), order, -(-n // ROWS_PER_RANGE))
    before, at, wanted = 0, None, n
    for r in placed.groupBy("_range").count().orderBy("_range").toLocalIterator():  # one row a range
        at, wanted = r["_range"], n - before
        if before + r["count"] >= n:
            break
        before += r["count"]
    inside = placed.where(F.col("_range") == F.lit(at)).orderBy(*order).limit(wanted)
    return inside.agg(F.max(F.struct(*order)).alias("_key")).scalar()


def limit_docs(df: DataFrame, n: int, *order: str) -> DataFrame:
    """Mark everything after the first ``n`` undropped rows; 0 keeps all.

    ``order`` must be unique.  The cut is a single key found from the order
    columns alone, so kept and dropped rows come from one filter each: the
    documents themselves are neither sorted nor shuffled.
    """
    if n == 0:
        return df if DROP in df.columns else _set_reason(df)
    if DROP not in df.columns:
        df = _set_reason(df)
    cut = _nth_key(df.where(F.col(DROP).isNull()), n, list(order))
    return _set_reason(df, (F.struct(*order) > cut, ref.REASON_LIMIT))


def global_rank(df: DataFrame, *order: str) -> DataFrame:
    """Dense 1-based ``rank`` over the whole table without a one-task window.

    Rows are range-partitioned once and that layout is written down; per-range
    counts (one row a range) give each range its offset.
    """
    placed = _in_ranges(df, list(order))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_range").count().select(
        "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    return (
        placed.withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_range")  # one row per range: bounded by `ranges`
        .withColumn("rank", F.col("_row") + F.col("_offset"))
        .drop("_range", "_row", "_offset")
    )


def _in_ranges(df: DataFrame, order: list[str], least: int = 1) -> DataFrame:
    """The rows with ``_range``, rising with ``order``, as a written table.

    Bounds come from a sample, so ``df`` is scanned twice and written once; there are as many
    ranges as the session has shuffle partitions, ``least`` at least.
    """
    spark = df.sparkSession
    ranges = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), least)
    return materialise(
        df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges",
    )


def kept(df: DataFrame) -> DataFrame:
    return df.where(F.col(DROP).isNull()).drop(DROP)


def dropped(df: DataFrame) -> DataFrame:
    return df.where(F.col(DROP).isNotNull())
