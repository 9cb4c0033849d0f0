"""Every registered query: ``(spark, sf_dir) -> DataFrame``.

Each runs an operator of the package over whole tables (``checks.views``).
Lists are shown as comma-joined text, so results do not depend on how a client
renders them.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import views as V
from docmonitor import schema
from docmonitor.functions import dates, departments, text, urls
from docmonitor.operators import documents as D
from docmonitor.operators import extract as X
from docmonitor.operators import files as J
from docmonitor.operators import navigate as N
from docmonitor.operators import publish as P
from docmonitor.operators import state as S
from docmonitor.params import RunParams
from docmonitor.plans.documents import classify, document_records
from docmonitor.plans.monitor import plan_run, published_documents, run_monitor
from docmonitor.plans.site import site_files, site_run as run_site
from docmonitor.plans.walk import walk
from docmonitor.session import configure, materialise, scratch_path
from docmonitor.sources import dims, pages as pages_src, registry, sinks, state as store
from docmonitor.streaming.monitor import stream_monitor

RUN_TS = dt.datetime(2002, 3, 4, 5, 6, 7)
PARAMS = RunParams(
    project="Suivi des avis", run_name="weekly", run_id="r-1", from_year=1995, to_year=2001,
    run_ts=RUN_TS, access_level="public",
)
SITE_PARAMS = RunParams(project="x", from_year=2022, to_year=2023, run_ts=RUN_TS)
LIMIT = 1000  # the upload limit under test
LARGE_LIMIT = 6000
SITE_RUN = RunParams(
    project="x", run_id="r-3", from_year=2022, to_year=2023, run_ts=RUN_TS, dry_run=False
)
DAY = dt.timedelta(days=1)

QUERIES: dict = {}


def query(fn):
    def run(spark, sf_dir):
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def joined(*names: str):
    return {n: F.array_join(n, ",") for n in names}


def written(rows: DataFrame, name: str) -> DataFrame:
    """Input that a query reads several times, as the table it stands for."""
    return materialise(rows, name)


def all_rows(spark, sf) -> DataFrame:
    """Plain files and all archive members, nothing skipped."""
    archives, plain = J.route_zip(V.docs_in(spark, sf))
    return J.as_plain_docs(plain).unionByName(J.expand_zip_docs(archives, V.members_in(spark, sf)))


# -- sources -----------------------------------------------------------------------
@query
def scan_pages(spark, sf):
    return pages_src.read_pages(spark, f"{sf}/pages.parquet")


@query
def scan_file_headers(spark, sf):
    path = scratch_path(spark, "headers")
    V.headers_in(spark, sf).write.parquet(path)
    return pages_src.read_file_headers(spark, path)


@query
def zip_members(spark, sf):
    return pages_src.zip_members(V.zip_files(spark, sf))


@query
def load_seen_state(spark, sf):
    path = scratch_path(spark, "state-json")
    target = store.export_seen_json(V.seen_in(spark, sf), path, RUN_TS)
    return store.load_seen(spark, target)


@query
def dim_departments(spark, sf):
    """Documents per department of the reference table."""
    docs = V.docs_in(spark, sf).groupBy(
        departments.department_code(F.col("department_label")).alias("code")
    ).agg(F.count(F.lit(1)).alias("n_docs"))
    return dims.dim_departments(spark).join(docs, "code").select("ord", "name", "code", "n_docs")


@query
def dim_regions(spark, sf):
    """Documents per region of the reference table."""
    docs = V.docs_in(spark, sf).groupBy(
        departments.department_code(F.col("department_label")).alias("code")
    ).agg(F.count(F.lit(1)).alias("n_docs"))
    regions = dims.dim_regions(spark).select("ord", "name", F.explode("codes").alias("code"))
    return regions.join(docs, "code").groupBy("ord", "name").agg(F.sum("n_docs").alias("n_docs"))


# -- sinks ----------------------------------------------------------------------------
@query
def items_feed(spark, sf):
    """The CSV feed, written and read back."""
    path = scratch_path(spark, "feed")
    docs = document_records(all_rows(spark, sf), PARAMS)
    sinks.write_items_csv(docs, path)
    columns = ", ".join(f"{c} string" for c in schema.FEED_COLUMNS)
    return spark.read.schema(columns).option("header", True).option("escape", '"').csv(path)


@query
def seen_state_json(spark, sf):
    return store.seen_json_lines(V.seen_in(spark, sf))


@query
def publish_records(spark, sf):
    docs = document_records(all_rows(spark, sf), PARAMS)
    return P.to_publish_records(docs, PARAMS)


@query
def run_report(spark, sf):
    return P.run_report(document_records(V.docs_in(spark, sf), PARAMS), PARAMS)


# -- html -------------------------------------------------------------------------------
@query
def department_links(spark, sf):
    return X.department_links(V.pages_in(spark, sf))


@query
def year_sections(spark, sf):
    return X.year_sections(V.pages_in(spark, sf)).drop("pos")


@query
def project_links(spark, sf):
    return X.project_links(V.pages_in(spark, sf))


@query
def next_page_links(spark, sf):
    return X.next_page(V.pages_in(spark, sf))


@query
def breadcrumb_year(spark, sf):
    return X.breadcrumb_year(V.pages_in(spark, sf))


@query
def page_titles(spark, sf):
    return X.page_title(V.pages_in(spark, sf))


@query
def download_links(spark, sf):
    return X.download_links(V.pages_in(spark, sf))


@query
def resolve_urls(spark, sf):
    """Every navigation link of the captured pages, made absolute."""
    pages = V.table(spark, sf, "pages")
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    links = pages.select("page_id", "url", F.posexplode(hrefs).alias("pos", "href"))
    return links.select(
        "page_id", "pos", "href", urls.resolve_url(F.col("url"), F.col("href")).alias("abs_url")
    )


@query
def department_codes(spark, sf):
    return V.docs_in(spark, sf).select(
        "crawl_seq", departments.department_code(F.col("department_label")).alias("code")
    )


# -- joins ---------------------------------------------------------------------------
@query
def follow_links(spark, sf):
    """From list pages to project titles."""
    pages = V.pages_in(spark, sf)
    hits = materialise(X.page_hits(pages, ("project", "title")), "hits", "kind")
    links = X.project_links(hits).select(F.col("url").alias("list_url"), "pos", "abs_url")
    return N.follow(links, X.page_title(hits))


@query
def paginate(spark, sf):
    hits = materialise(
        X.page_hits(V.pages_in(spark, sf), ("section_link", "next")), "hits", "kind"
    )
    first = X.year_sections(hits).select(
        F.col("abs_url").alias("url"), F.array("block_pos", "pos").alias("seq")
    )
    return N.paginate(first, X.next_page(hits)).select("start_url", "url", "page")


@query
def walk_to_files(spark, sf):
    return walk(written(V.pages_in(spark, sf), "pages"), V.START_URL, SITE_PARAMS).drop("crawl_path")


@query
def frontier(spark, sf):
    """Linked but not captured: the file links and the links of the site's frame."""
    pages = V.pages_in(spark, sf)
    hits = X.page_hits(pages, ("section_link", "project", "next", "download"))
    return N.frontier(hits, pages)


@query
def with_headers(spark, sf):
    files = V.docs_in(spark, sf).select("crawl_seq", "source_file_url")
    return J.with_headers(files, V.headers_in(spark, sf))


@query
def not_seen_links(spark, sf):
    return J.not_seen(V.docs_in(spark, sf), V.seen_in(spark, sf)).select(
        "crawl_seq", "source_file_url"
    )


@query
def not_seen_final(spark, sf):
    return J.not_seen_final(V.docs_in(spark, sf), V.seen_in(spark, sf)).select(
        "crawl_seq", "source_file_url"
    )


@query
def not_seen_members(spark, sf):
    return J.not_seen_members(V.members_in(spark, sf), V.seen_in(spark, sf))


@query
def expand_zip_docs(spark, sf):
    archives, _ = J.route_zip(V.docs_in(spark, sf))
    return J.expand_zip_docs(archives, V.members_in(spark, sf)).drop("title")


# -- filters ---------------------------------------------------------------------------
@query
def target_years(spark, sf):
    params = RunParams(project="x", from_year=1996, to_year=1998)
    return N.target_years(
        V.docs_in(spark, sf).select("crawl_seq", "publication_lastmodified"),
        "publication_lastmodified", params,
    )


@query
def route_zip(spark, sf):
    docs = V.docs_in(spark, sf).select("crawl_seq", "source_file_url")
    archives, plain = J.route_zip(docs)
    return archives.withColumn("route", F.lit("zip")).unionByName(
        plain.withColumn("route", F.lit("file"))
    )


@query
def supported_filetypes(spark, sf):
    rows = D.source_filename(V.docs_in(spark, sf))
    return D.supported_only(rows, PARAMS.supported_extensions).select(
        "crawl_seq", "source_filename", F.col(D.DROP).alias("reason")
    )


def _limited(spark, sf, n):
    rows = D.source_filename(V.docs_in(spark, sf))
    rows = D.supported_only(rows, PARAMS.supported_extensions)
    return D.limit_docs(rows, n, "crawl_seq").select("crawl_seq", F.col(D.DROP).alias("reason"))


@query
def upload_limit(spark, sf):
    return _limited(spark, sf, LIMIT)


@query
def upload_limit_large(spark, sf):
    """A larger limit."""
    return _limited(spark, sf, LARGE_LIMIT)


@query
def dedupe_requests(spark, sf):
    """First file seen on each project page."""
    docs = V.docs_in(spark, sf).select("source_page_url", "crawl_seq", "source_file_url")
    return N.dedupe_requests(docs, "source_page_url", "crawl_seq")


@query
def quarantine(spark, sf):
    params = RunParams(project="x", from_year=1995, to_year=2001, run_ts=RUN_TS)
    return classify(all_rows(spark, sf), params).select(
        "crawl_seq", "member_path", F.col(D.DROP).alias("reason")
    )


# -- scalar functions -----------------------------------------------------------------
@query
def parse_http_date(spark, sf):
    return D.parse_http_date(
        V.docs_in(spark, sf).select("crawl_seq", "publication_lastmodified")
    ).drop("publication_ts")


@query
def iso_last_modified(spark, sf):
    ts = dates.http_timestamp(F.col("publication_lastmodified"))
    return V.docs_in(spark, sf).select(
        "crawl_seq", dates.iso_last_modified(ts).alias("last_modified")
    )


@query
def categorize(spark, sf):
    return D.categorize(V.docs_in(spark, sf)).select("crawl_seq", "category")


@query
def source_filename(spark, sf):
    return D.source_filename(V.docs_in(spark, sf)).select("crawl_seq", "source_filename")


@query
def clean_project(spark, sf):
    return V.docs_in(spark, sf).select(
        "crawl_seq", text.clean_project(F.col("project")).alias("project")
    )


@query
def clean_title(spark, sf):
    return V.docs_in(spark, sf).select(
        "crawl_seq", text.clean_title(F.col("title")).alias("title")
    )


@query
def file_ext(spark, sf):
    return D.source_filename(V.docs_in(spark, sf)).select(
        "crawl_seq", text.file_ext(F.col("source_filename")).alias("ext")
    )


@query
def zip_titles(spark, sf):
    return V.members_in(spark, sf).select(
        "zip_url", "member_path", text.zip_title(F.col("member_path")).alias("title")
    )


@query
def project_id(spark, sf):
    docs = V.docs_in(spark, sf).withColumn("project", text.clean_project(F.col("project")))
    return D.project_id(docs).select("crawl_seq", "project_id")


@query
def event_keys(spark, sf):
    return D.event_key(all_rows(spark, sf)).select(
        "crawl_seq", "member_path", "event_data_key", "source_file_zip_path"
    )


@query
def data_payload(spark, sf):
    docs = document_records(all_rows(spark, sf), PARAMS)
    return docs.select(
        "crawl_seq", "member_path", F.to_json(P.data_payload(PARAMS)).alias("data")
    )


@query
def year_label(spark, sf):
    """Span of publication years of each project page."""
    spans = V.docs_in(spark, sf).groupBy("source_page_url").agg(
        F.min("year").alias("first"), F.max("year").alias("last")
    )
    return spans.select(
        "source_page_url", P.year_label(F.col("first"), F.col("last")).alias("label")
    )


@query
def original_ext(spark, sf):
    return D.source_filename(V.docs_in(spark, sf)).select(
        "crawl_seq", text.original_ext(F.col("source_filename")).alias("ext")
    )


@query
def constant_columns(spark, sf):
    docs = V.docs_in(spark, sf).select("crawl_seq", "title")
    return D.with_constants(docs, PARAMS)


# -- departments -----------------------------------------------------------------------
def _cleaned(spark, sf):
    return V.docs_in(spark, sf).select(
        "crawl_seq", "authority", "department_label",
        text.clean_project(F.col("project")).alias("project"),
    )


@query
def dept_from_authority(spark, sf):
    return _cleaned(spark, sf).select(
        "crawl_seq", departments.dept_from_authority(F.col("authority")).alias("code")
    )


@query
def dept_numbers(spark, sf):
    return _cleaned(spark, sf).select(
        "crawl_seq", F.array_join(departments.dept_numbers(F.col("project")), ",").alias("codes")
    )


@query
def dept_names(spark, sf):
    codes = departments.sorted_codes(departments.dept_names(F.col("project")))
    return _cleaned(spark, sf).select("crawl_seq", F.array_join(codes, ",").alias("codes"))


@query
def dept_regions(spark, sf):
    codes = departments.sorted_codes(departments.dept_regions(F.col("project")))
    return _cleaned(spark, sf).select("crawl_seq", F.array_join(codes, ",").alias("codes"))


@query
def depts_from_project(spark, sf):
    return _cleaned(spark, sf).select(
        "crawl_seq",
        F.array_join(departments.depts_from_project(F.col("project")), ",").alias("codes"),
    )


@query
def tag_departments(spark, sf):
    rows = _cleaned(spark, sf).select(
        "*", departments.department_code(F.col("department_label")).alias("department_from_scraper")
    ).where("department_from_scraper IS NOT NULL")
    return D.tag_departments(rows).select(
        "crawl_seq", F.array_join("departments", ",").alias("departments"),
        F.array_join("departments_sources", ",").alias("departments_sources"),
    )


# -- aggregates and state ------------------------------------------------------------------
@query
def zip_supported_files(spark, sf):
    """Shown as one list an archive; the operator itself gives a row a file."""
    files = J.zip_supported_files(V.members_in(spark, sf), PARAMS.supported_extensions)
    lists = files.groupBy("zip_url").agg(F.sort_array(F.collect_list("member_path")).alias("supported_files"))
    return lists.withColumns(joined("supported_files"))


def _second_run_on(spark, sf, limit=0):
    params = RunParams(
        project="x", from_year=1995, to_year=2001, run_ts=RUN_TS, upload_limit=limit
    )
    members = written(V.members_in(spark, sf), "members")
    seen = written(V.seen_in(spark, sf, members), "seen")
    return plan_run(V.docs_in(spark, sf), members, seen, params), seen, members


def _second_run(spark, sf, limit=0):
    return _second_run_on(spark, sf, limit)[0]


@query
def complete_zips(spark, sf):
    run, seen, members = _second_run_on(spark, sf)
    return J.complete_zips(run.accepted, members, seen, PARAMS.supported_extensions)


@query
def run_counts(spark, sf):
    return P.run_counts(V.seen_in(spark, sf), _second_run(spark, sf).accepted)


@query
def report_items(spark, sf):
    return P.report_items(document_records(V.docs_in(spark, sf), PARAMS)).drop("member_path")


@query
def drop_counts(spark, sf):
    return P.drop_counts(_second_run(spark, sf, LIMIT).rows)


@query
def upsert_documents(spark, sf):
    accepted = document_records(all_rows(spark, sf), PARAMS)
    return S.upsert_documents(V.seen_in(spark, sf), accepted, RUN_TS)


@query
def upsert_zips(spark, sf):
    run, seen, members = _second_run_on(spark, sf)
    accepted = written(run.accepted.select(
        "file_from_zip", "source_file_url", "event_data_key", "publication_lastmodified", "year"), "accepted")
    complete = J.complete_zips(accepted, members, seen, PARAMS.supported_extensions)
    return S.upsert_zips(seen, complete, accepted, RUN_TS)


@query
def resolve_project(spark, sf):
    return S.resolve_project(V.project_requests(spark, sf), V.projects_in(spark, sf))


# -- whole runs ---------------------------------------------------------------------------
@query
def document_records_(spark, sf):
    """The flagship: file rows in, publishable documents out."""
    docs = document_records(V.docs_in(spark, sf), PARAMS)
    return docs.select(
        "crawl_seq", "title", "project", "project_id", "authority", "category", "category_local",
        "source_filename", "source_file_url", "source_page_url", "publication_datetime_dcformat",
        "year", *[F.array_join(c, ",").alias(c) for c in ("departments", "departments_sources")],
    )


def _written_run(spark, sf, root, members, start):
    params = RunParams(
        project="x", run_id="r-2", from_year=1995, to_year=2001, run_ts=RUN_TS, dry_run=False
    )
    store.write_seen(V.seen_in(spark, sf, members), root, -1)
    store.commit_batch(spark, root, -1, "r-1", RUN_TS, 0)
    start(params)
    return store.read_seen(spark, root)


@query
def monitor_run(spark, sf):
    """State after one written run on top of an earlier one."""
    root, members = scratch_path(spark, "monitor"), written(V.members_in(spark, sf), "members")
    return _written_run(spark, sf, root, members, lambda params: run_monitor(
        V.docs_in(spark, sf), members, params, root, 0
    ))


@query
def monitor_stream(spark, sf):
    """The same run, with the files arriving as a stream."""
    root, members = scratch_path(spark, "monitor-stream"), written(V.members_in(spark, sf), "members")
    orders = V.table(spark, sf, "orders")
    arriving = pages_src.stream_pages(spark, sf, orders.schema, pathGlobFilter="orders.parquet")
    files = V.docs_base_of(arriving).drop("status", "priority")

    def start(params):
        stream_monitor(
            files, members, params, root, clock=lambda: RUN_TS
        ).awaitTermination()

    return _written_run(spark, sf, root, members, start)


@query
def monitor_mixed(spark, sf):
    """Finished orders' files in a batch run, all files then as a stream on the same root."""
    root, members = scratch_path(spark, "monitor-mixed"), written(V.members_in(spark, sf), "members")
    orders = V.table(spark, sf, "orders")
    arriving = pages_src.stream_pages(spark, sf, orders.schema, pathGlobFilter="orders.parquet")
    files = V.docs_base_of(arriving).drop("status", "priority")

    def start(params):
        run_monitor(
            V.docs_base_of(orders).where("status = 'F'").drop("status", "priority"),
            members, params, root, 0,
        )
        stream_monitor(
            files, members, params, root, clock=lambda: RUN_TS
        ).awaitTermination()

    return _written_run(spark, sf, root, members, start)


@query
def published_after_run(spark, sf):
    """Documents two runs in a row have published: the second adds none."""
    root, members = scratch_path(spark, "published"), written(V.members_in(spark, sf), "members")

    def start(params):
        for batch in (0, 1):
            run_monitor(V.docs_in(spark, sf), members, params, root, batch)

    _written_run(spark, sf, root, members, start)
    return published_documents(spark, root).select("batch", "event_data_key", "project_id")


# -- from pages to publication ------------------------------------------------------------
def _site_runs(spark, sf, root, params, batches=(0,)):
    """Runs over the faulty site, on top of an earlier state."""
    members = written(V.site_members_in(spark, sf), "members")
    pages = written(V.pages_in(spark, sf, faulty=True), "pages")
    store.write_seen(V.site_seen_in(spark, sf, members), root, -1)
    store.commit_batch(spark, root, -1, "r-1", RUN_TS, 0)
    for batch in batches:
        run_site(pages, V.site_headers_in(spark, sf), members, params, root, batch, V.START_URL)


@query
def site_run(spark, sf):
    """What two runs over one site have published: the second adds none."""
    root = scratch_path(spark, "site")
    _site_runs(spark, sf, root, SITE_RUN, (0, 1))
    return published_documents(spark, root).select(
        "batch", "event_data_key", "project_id", "title", "source_page_url", "department_from_scraper", "year"
    )


@query
def site_run_limited(spark, sf):
    """The first documents in the walk's order."""
    root = scratch_path(spark, "site-limited")
    _site_runs(spark, sf, root, replace(SITE_RUN, upload_limit=LIMIT))
    return published_documents(spark, root).select("event_data_key", "title")


@query
def walk_drops(spark, sf):
    """All that a walk over a faulty site loses, with reasons."""
    _, lost = site_files(
        written(V.pages_in(spark, sf, faulty=True), "pages"), V.site_headers_in(spark, sf),
        V.site_seen_in(spark, sf), V.START_URL, SITE_RUN,
    )
    return lost


@query
def run_metrics(spark, sf):
    """Counts that a run kept in its manifest row."""
    root = scratch_path(spark, "metrics")
    _site_runs(spark, sf, root, replace(SITE_RUN, upload_limit=LIMIT))
    runs = store.committed_batches(spark, root).where("batch_id = 0")
    counts = F.map_concat(F.create_map(F.lit("accepted"), F.col("accepted")), F.col("dropped"))
    return runs.select(F.explode(counts).alias("name", "n"))


def _varied(url, n):
    """Other forms of an address, some of the same request."""
    return (
        F.when(n == 0, url).when(n == 1, F.concat(url, F.lit("?b=2&a=1&&c")))
        .when(n == 2, F.concat(url, F.lit("?a=1&c=&b=2#part")))
        .when(n == 3, F.replace(url, F.lit(".example."), F.lit(".EXAMPLE.")))
        .when(n == 4, F.concat(url, F.lit("?q=%e9+x%20y&q=%7e&%=")))
        .when(n == 5, F.regexp_replace(url, "^(https?://[^/]*)", "$1:443"))
        .otherwise(F.concat(url, F.lit(" é%41%2f%3F")))
    )


@query
def request_identity(spark, sf):
    """Requests behind the links of all pages, each link in one of seven forms."""
    pages = V.table(spark, sf, "pages")
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    links = pages.select("page_id", "url", F.posexplode(hrefs).alias("pos", "href"))
    links = links.withColumn("link", urls.resolve_url(F.col("url"), F.col("href")))
    links = links.withColumn("link", _varied(F.col("link"), F.expr("(page_id + pos) % 7")))
    links = links.select("page_id", "pos", urls.request_identity(F.col("link")).alias("request"))
    first = N.dedupe_requests(links, "request", "page_id", "pos")
    return first.join(links.groupBy("request").agg(F.count(F.lit(1)).alias("links")), "request")


@query
def project_registry(spark, sf):
    """Ids after two allocations with titles in common, the second of them repeated."""
    root = scratch_path(spark, "registry")
    requests, projects = V.project_requests(spark, sf), V.projects_in(spark, sf)
    first = requests.where(F.length("project") % 2 == 0)
    for asked, allocation in ((first, 0), (requests, 1), (requests, 1)):
        found = registry.allocate_projects(asked, projects, root, allocation)
    given = registry.created_projects(spark, root).select("project", "allocation")
    return found.join(given, "project", "left")


@query
def seen_as_of(spark, sf):
    """The state after each of three runs, read after a compaction."""
    root = scratch_path(spark, "as-of")
    docs, members = V.docs_in(spark, sf), written(V.members_in(spark, sf), "members")
    params = RunParams(project="x", from_year=1995, to_year=2001, run_ts=RUN_TS, dry_run=False)
    store.write_seen(V.seen_in(spark, sf, members), root, -1)
    store.commit_batch(spark, root, -1, "r-1", RUN_TS, 0)
    run_monitor(docs.where("crawl_seq % 4 < 2"), members, replace(params, run_ts=RUN_TS + DAY), root, 0)
    store.compact_seen(spark, root, 4)
    run_monitor(docs, members, replace(params, run_ts=RUN_TS + 2 * DAY), root, 1)
    store.compact_seen(spark, root, 4)
    states = [store.read_seen_as_of(spark, root, RUN_TS + n * DAY).withColumn("runs", F.lit(n)) for n in range(3)]
    return states[0].unionByName(states[1]).unionByName(states[2])


@query
def zip_progress(spark, sf):
    """Archives in the state after each of three limited runs, finished by their progress alone."""
    root = scratch_path(spark, "progress")
    params = RunParams(project="x", from_year=1995, to_year=2001, dry_run=False, upload_limit=LIMIT, run_ts=RUN_TS)
    members = written(V.members_in(spark, sf), "members")
    store.write_seen(V.seen_in(spark, sf, members), root, -1)
    store.commit_batch(spark, root, -1, "r-1", RUN_TS, 0)
    for n in range(3):
        run_monitor(V.docs_in(spark, sf), members, replace(params, run_ts=RUN_TS + (n + 1) * DAY), root, n)
    return store.read_seen(spark, root).where("kind = 'zips'").select("key", "last_seen")


QUERIES["document_records"] = QUERIES.pop("document_records_")
