"""Following links from page to page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docmonitor.functions.urls import request_url
from docmonitor.params import RunParams
from docmonitor.session import materialise


def in_target_years(title: Column, from_year: int, to_year: int) -> Column:
    """Does the title contain any of the years as text?"""
    test = F.lit(False)
    for year in range(from_year, to_year + 1):
        test = test | F.contains(title, F.lit(str(year)))
    return test


def target_years(df: DataFrame, col: str, params: RunParams) -> DataFrame:
    return df.where(in_target_years(F.col(col), params.from_year, params.to_year))


def dedupe_requests(df: DataFrame, key: str | list[str], *order: str) -> DataFrame:
    """One row per request, the first in ``order``.

    Spark ranks inside each map task before the shuffle, so a key that holds a
    third of all rows sends one row per task.
    """
    keys = [key] if isinstance(key, str) else key
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def follow(links: DataFrame, pages: DataFrame, on: str = "abs_url") -> DataFrame:
    """Links whose target was captured, with the target's columns.

    ``pages`` has one row per url; it should be a table of parsed hits or of
    urls rather than raw html, so that the join moves small rows.  Columns of
    the links' own page are carried on unless the target has the same name.
    """
    carried = [c for c in links.columns if c not in pages.columns]
    return links.select(*carried).join(
        pages, request_url(F.col(on)) == request_url(pages["url"]), "inner"
    )


def frontier(links: DataFrame, pages: DataFrame, on: str = "abs_url") -> DataFrame:
    """Link targets no page was captured for: what a capture job fetches next."""
    wanted = links.select(request_url(F.col(on)).alias("url")).where("url IS NOT NULL").distinct()
    return wanted.join(pages.select(request_url(F.col("url")).alias("url")), "url", "left_anti")


def paginate(first_pages: DataFrame, next_links: DataFrame, order: str = "seq") -> DataFrame:
    """Every list page reachable from a first page: ``(start_url, url, page, seq)``.

    ``first_pages(url, <order>)`` are the entry pages, ``next_links(url, abs_url)``
    holds at most one next link a page.  Path doubling: round k joins jumps of
    2^k pages, so a chain of n pages takes log2(n) rounds of two small joins
    instead of n.  A page belongs to the chain that reaches it first (fewest
    pages, then ``order``); a cycle ends where it meets itself.  No page limit.
    """
    reached = materialise(
        first_pages.select(
            F.col("url").alias("start_url"), request_url(F.col("url")).alias("url"), F.lit(1).cast("long").alias("page"),
            F.col(order).alias("seq"),
        ),
        "reached",
    )
    jumps = next_links.select(
        request_url(F.col("url")).alias("src"), request_url(F.col("abs_url")).alias("dst")
    )
    jumps = materialise(jumps.where("dst IS NOT NULL AND src <> dst"), "jumps")
    known, step = reached.count(), 1
    while True:
        further = reached.join(jumps, F.col("url") == F.col("src")).select(
            "start_url", F.col("dst").alias("url"),
            (F.col("page") + step).alias("page"), "seq",
        )
        reached = materialise(
            dedupe_requests(reached.unionByName(further), "url", "page", "seq"), "reached"
        )
        now = reached.count()
        if now == known:
            return reached
        known, step = now, step * 2
        far = jumps.select(F.col("src").alias("mid"), F.col("dst").alias("far"))
        jumps = materialise(
            jumps.join(far, F.col("dst") == F.col("mid")).select("src", F.col("far").alias("dst")),
            "jumps",
        )
