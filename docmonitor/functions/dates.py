"""HTTP dates (native expressions; the session time zone must be UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmonitor import reference_data as ref

# The weekday prefixes an HTTP date may start with.
_WEEKDAYS = ("mon, ", "tue, ", "wed, ", "thu, ", "fri, ", "sat, ", "sun, ")


def http_timestamp(col: Column) -> Column:
    """Timestamp of ``Mon, 05 Feb 2024 10:11:12 GMT``; null when malformed."""
    return F.when(
        F.lower(F.left(col, F.lit(5))).isin(*_WEEKDAYS),
        F.try_to_timestamp(F.substr(col, F.lit(6)), F.lit(ref.HTTP_DATE_FORMAT)),
    )


def publication_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def publication_time(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss 'UTC'")


def publication_datetime(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss 'UTC'")


def publication_datetime_dcformat(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def iso_last_modified(ts: Column) -> Column:
    """Form kept in the state: ISO, no zone."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
