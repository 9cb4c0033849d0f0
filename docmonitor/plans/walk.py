"""The full walk over captured pages: start page to file links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmonitor.functions.urls import request_identity
from docmonitor.operators import extract as X
from docmonitor.operators import navigate as N
from docmonitor.operators.documents import DROP, kept
from docmonitor.params import RunParams
from docmonitor.session import materialise

NAVIGATION = ("department", "section_link", "next", "breadcrumb", "project")
DETAILS = ("title", "download")
BROADCAST_URLS = 1_000_000  # of some 100 bytes


@dataclass(frozen=True)
class Walk:
    """What a walk reached."""

    files: DataFrame  # file links, with the reason (``_drop_reason``) where they go no further
    pages: DataFrame  # ``url, reason`` of pages it had to leave


def _targets(links: DataFrame) -> DataFrame:
    return links.withColumn("target", request_identity(F.col("abs_url")))


def _unvisited(links: DataFrame, *visited: DataFrame) -> DataFrame:
    """A page is requested once in a run, on whichever level it comes first."""
    for urls in visited:
        links = links.join(urls.select(F.col("url").alias("target")), "target", "left_anti")
    return links


def _request(links: DataFrame, order: str = "path") -> DataFrame:
    """One row per target, its address as ``url`` from here on."""
    return N.dedupe_requests(links, "target", order).withColumnRenamed("target", "url")


def _hits(pages: DataFrame, kinds, name: str) -> DataFrame:
    """Parsed once, in a pass without a shuffle; resolved against the page's own address."""
    found = X.page_hits(pages, kinds).withColumn("url", request_identity(F.col("url")))
    return materialise(found, name)


def pages_of(pages: DataFrame, reached: DataFrame) -> DataFrame:
    """The pages at ``reached`` urls, so that only those are parsed.

    Beyond a bound all are taken: a join by shuffle would move the html, which costs more
    than to parse pages in vain.
    """
    urls = reached.select(F.col("url").alias("_url")).distinct()
    if urls.count() > BROADCAST_URLS:
        return pages
    return pages.join(F.broadcast(urls), request_identity(pages["url"]) == F.col("_url"), "left_semi")


def walk_all(pages: DataFrame, start_url: str, params: RunParams) -> Walk:
    """The walk with all that it loses on the way.

    Navigation is parsed first; project pages only once it is known which are reached.  Every
    hop joins link tables, which are a small fraction of the pages.  A list page without a
    year ends its chain, as nothing behind it could be dated; a file link without a
    text, and all links of a project without a title, go no further.  Kept and lost rows come out of
    the same outer joins.
    """
    hits = _hits(pages, NAVIGATION, "page-hits")

    # start page -> departments
    menu = X.department_links(hits.where(F.col("url") == request_identity(F.lit(start_url))))
    departments = _request(_targets(menu).select(
        "department", "target", F.array("pos").alias("path")
    ))

    # departments -> first list pages, only for the wanted years
    sections = N.target_years(X.year_sections(hits), "section_title", params)
    lists = departments.join(_targets(sections), "url").select(
        "department", "subdiv", "target",
        F.concat("path", F.array("block_pos", "pos")).alias("path"),
    )
    lists = materialise(_request(_unvisited(lists, departments)), "first-lists")

    # list pages -> all their next pages
    years = X.breadcrumb_year(hits)
    following = X.next_page(hits).join(years.select("url"), "url", "left_semi")
    chains = N.paginate(lists, _unvisited(_targets(following), departments), order="path")
    context = lists.select(F.col("url").alias("start_url"), "department", "subdiv")
    captured = pages.select(request_identity(F.col("url")).alias("url"), F.lit(True).alias("captured")).distinct()
    list_pages = (
        chains.join(context, "start_url").join(captured, "url", "left").join(years, "url", "left")
        .select("url", "department", "subdiv", "year", "page", "captured",
                F.concat("seq", F.array(F.col("page").cast("int"))).alias("path"))
    )

    # list pages -> projects
    cards = _targets(X.project_links(hits)).select("url", "abs_url", "target", "pos")
    projects = list_pages.where("year IS NOT NULL").join(cards, "url").select(
        "department", "subdiv", "year", "page", "abs_url", "target",
        F.concat("path", F.array("pos")).alias("path"),
    )
    projects = _request(_unvisited(projects, departments, chains)).withColumnRenamed(
        "abs_url", "source_page_url"
    )
    projects = materialise(projects.join(captured, "url", "left"), "projects")

    # projects -> files
    details = _hits(pages_of(pages, projects), DETAILS, "project-hits")
    files = (
        projects.join(X.page_title(details), "url", "left")
        .join(_targets(X.file_links(details)), "url")
        .select(
            F.concat("path", F.array("pos")).alias("crawl_path"),
            "department", "year", "subdiv", "page", "project", "source_page_url", "title",
            F.col("abs_url").alias("source_file_url"), "target",
            F.when(F.col("title").isNull(), "No link text")
            .when(F.col("project").isNull(), "Empty project").alias(DROP),
        )
    )
    # a request is made by a link that goes further, so lost links take none away
    files = N.dedupe_requests(files, ["target", DROP], "crawl_path")
    files = materialise(files.drop("target"), "walked-files")
    left = list_pages.where("year IS NULL").unionByName(
        projects.where("captured IS NULL"), allowMissingColumns=True)
    left = left.select("url", F.when(F.col("captured"), "No year").otherwise("Page not captured").alias("reason"))
    return Walk(files, left)


def walk(pages: DataFrame, start_url: str, params: RunParams) -> DataFrame:
    """``(crawl_path, department, year, subdiv, page, project, source_page_url, title, source_file_url)``.

    ``crawl_path`` orders rows as a page-by-page reader would meet them.  A project without a title
    has a null here; a request that a titled project makes too is that one's.
    """
    files = walk_all(pages, start_url, params).files
    titled, untitled = kept(files), files.where(F.col(DROP) == "Empty project").drop(DROP)
    asked = titled.select(request_identity(F.col("source_file_url")).alias("_asked"))
    alone = untitled.join(asked, request_identity(F.col("source_file_url")) == F.col("_asked"), "left_anti")
    return titled.unionByName(alone)
