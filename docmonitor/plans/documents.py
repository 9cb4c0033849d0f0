"""From document rows to publishable records, in one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmonitor.functions.departments import department_code
from docmonitor.operators import documents as D
from docmonitor.params import RunParams
from docmonitor.session import require_utc

ORDER = ("crawl_seq", "member_path")


def judge(df: DataFrame, params: RunParams) -> DataFrame:
    """Every input row as it came, with ``_drop_reason`` (null = accepted).

    No shuffle: with a limit, its cut is one scalar found beforehand.
    """
    require_utc(df.sparkSession)
    rows = df.transform(D.quarantine).transform(D.supported_only, params.supported_extensions)
    return D.limit_docs(rows, params.upload_limit, *ORDER).transform(D.quarantine_late)


def clean(rows: DataFrame, params: RunParams) -> DataFrame:
    """Judged rows, cleaned and tagged."""
    return (
        rows.withColumns({
            "department_from_scraper": department_code(F.col("department_label")),
            "source_scraper": F.lit(params.source_scraper),
        })
        .transform(D.parse_http_date)
        .transform(D.categorize)
        .transform(D.source_filename)
        .transform(D.beautify)
        .transform(D.tag_departments)
        .transform(D.project_id)
        .transform(D.event_key)
    )


def classify(df: DataFrame, params: RunParams) -> DataFrame:
    """Every input row, cleaned and tagged, with ``_drop_reason``.

    Reasons come first and from the raw columns, so a filter on them reaches the
    scan and only rows that stay are cleaned.
    """
    return clean(judge(df, params), params)


def document_records(df: DataFrame, params: RunParams) -> DataFrame:
    """Accepted documents."""
    return classify(df, params).transform(D.kept)
