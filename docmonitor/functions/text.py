"""Text clean-up of titles, project names and file names (native expressions).

``replace`` rather than ``translate``: the latter looks every character up in a
map and takes many times as long on texts that need no change.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmonitor import reference_data as ref


def strip(col: Column) -> Column:
    """Remove white space of any kind (not only blanks) at both ends."""
    return F.btrim(col, F.lit(ref.WHITESPACE))


def _rest(col: Column) -> Column:
    return F.substr(col, F.lit(2))


def _bare_project(col: Column) -> Column:
    text = F.replace(strip(col), F.lit("\u00a0"), F.lit(" "))
    return F.rtrim(F.replace(text, F.lit("\u2019"), F.lit("'")), F.lit(".,"))


def _bare_title(col: Column) -> Column:
    return strip(F.rtrim(F.replace(col, F.lit("_"), F.lit(" ")), F.lit(".,")))


def clean_project(col: Column) -> Column:
    """Readable project name.

    Not idempotent (a dot hidden behind a blank survives one pass), so apply it
    exactly once.  The costly pattern only runs on texts that can match it.
    """
    text = _bare_project(col)
    text = F.when(
        F.contains(text, F.lit(") : ")),
        F.regexp_replace(text, ref.CITY_PREFIX_PATTERN, "$2 - $1"),
    ).otherwise(text)
    text = strip(text)
    return F.concat(F.initcap(F.left(text, F.lit(1))), _rest(text))


def clean_title(col: Column) -> Column:
    """Readable document title; dots and commas go before blanks do."""
    text = _bare_title(col)
    return F.concat(F.upper(F.left(text, F.lit(1))), _rest(text))


def blank_project(col: Column) -> Column:
    """Is ``clean_project(col)`` empty?  Without the patterns: moving the city
    never empties a name."""
    return F.coalesce(strip(_bare_project(col)), F.lit("")) == ""


def blank_title(col: Column) -> Column:
    """Is ``clean_title(col)`` empty?"""
    return F.coalesce(_bare_title(col), F.lit("")) == ""


def file_ext(filename: Column) -> Column:
    """Lower-cased extension with its dot, or ``''``; leading dots start none."""
    return F.lower(F.regexp_extract(filename, r"(?s)^\.*[^.].*(\.[^.]*)$", 1))


def original_ext(filename: Column) -> Column:
    """Extension without its leading dots."""
    return F.ltrim(file_ext(filename), F.lit("."))


def zip_title(member_path: Column) -> Column:
    """Folders and file stem of an archive member, joined by ``" - "``."""
    ext = file_ext(F.substring_index(member_path, "/", -1))
    stem = F.left(member_path, F.length(member_path) - F.length(ext))
    return F.replace(stem, F.lit("/"), F.lit(" - "))


def category(category_local: Column) -> Column:
    """The one known category, or null."""
    return F.when(
        F.contains(F.lower(category_local), F.lit(ref.CATEGORY_KEYWORD)),
        F.lit(ref.CATEGORY_LABEL),
    )
