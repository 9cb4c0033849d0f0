"""Links, titles and years found on captured pages.

``page_hits`` reads a page table once, without a shuffle, and turns html into a
small table of tagged links.  The functions below are plain filters over that
table, so a job parses each page once (``materialise`` the hits) however many
of them it uses.  Each also accepts a page table directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmonitor.functions import html as H
from docmonitor.functions.text import strip

KINDS = tuple(H.MARKERS)


def page_hits(pages: DataFrame, kinds=KINDS) -> DataFrame:
    """``(url, kind, block_pos, block_class, block_title, pos, text, own_text, href, abs_url)``.

    Pages that cannot hold any of ``kinds`` are dropped before the Python worker
    sees them; the html column goes no further than the parser.
    """
    found = (
        pages.select("url", "html")
        .where(H.may_have(F.col("html"), kinds))
        .select("url", H.html_hits("html", "url", kinds).alias("hits"))
    )
    # not `inline`: Spark would test the list for emptiness by parsing twice
    return found.select("url", F.inline_outer("hits")).where(F.col("kind").isin(*kinds))


def _of(source: DataFrame, kind: str) -> DataFrame:
    hits = page_hits(source, (kind,)) if "html" in source.columns else source
    return hits.where(F.col("kind") == kind)


def department_links(source: DataFrame) -> DataFrame:
    """Entries of the first menu only; the label is left as written."""
    return (
        _of(source, "department")
        .where((F.col("block_pos") == 0) & F.col("href").isNotNull())
        .select("url", "pos", F.col("text").alias("department"), "href", "abs_url")
    )


def year_sections(source: DataFrame) -> DataFrame:
    """Links of both section layouts: with subdivisions, or a single link."""
    return (
        _of(source, "section_link")
        .where(F.col("href").isNotNull() & F.col("block_title").isNotNull())
        .select(
            "url", "block_pos", "pos",
            strip(F.col("block_title")).alias("section_title"),
            F.when(F.col("block_class") == "many", strip(F.col("text")))
            .otherwise(F.lit("")).alias("subdiv"),
            "href", "abs_url",
        )
    )


def project_links(source: DataFrame) -> DataFrame:
    return (
        _of(source, "project")
        .where(F.col("href").isNotNull())
        .select("url", "pos", "text", "href", "abs_url")
    )


def next_page(source: DataFrame) -> DataFrame:
    """At most one row a page: the first next link that leads somewhere."""
    return _of(source, "next").where(F.col("pos") == 0).select("url", "href", "abs_url")


def breadcrumb_year(source: DataFrame) -> DataFrame:
    """Text of the eighth breadcrumb link, as written; no row when there are fewer."""
    return _of(source, "breadcrumb").where(F.col("pos") == 7).select(
        "url", F.col("text").alias("year")
    )


def page_title(source: DataFrame) -> DataFrame:
    """First text directly inside a title heading."""
    return _of(source, "title").select("url", F.col("own_text").alias("project"))


def file_links(source: DataFrame) -> DataFrame:
    """All links to files; those without a text have no ``title``."""
    return _of(source, "download").where(F.col("href").isNotNull()).select(
        "url", "pos", strip(F.col("text")).alias("title"), "href", "abs_url"
    )


def download_links(source: DataFrame) -> DataFrame:
    return file_links(source).where(F.col("title").isNotNull())
