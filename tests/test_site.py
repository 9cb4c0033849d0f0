"""From pages to publication: losses, order, identity of requests, and what runs keep."""

import datetime as dt
import random
import zipfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from docmonitor import schema
from docmonitor.functions.urls import request_identity
from docmonitor.operators import documents as D
from docmonitor.operators import files as J
from docmonitor.operators import publish as P
from docmonitor.params import RunParams
from docmonitor.plans import walk as W
from docmonitor.plans.documents import classify
from docmonitor.plans.monitor import new_rows, published_documents, run_monitor
from docmonitor.plans.site import path_key, site_files, site_run
from docmonitor.session import scratch_path
from docmonitor.sources import pages as pages_src
from docmonitor.sources import registry, state as store

SITE = "https://docs.example.org/"
TS = dt.datetime(2024, 5, 6, 7, 8, 9)
PARAMS = RunParams(project="x", run_id="r", from_year=2023, to_year=2023, run_ts=TS, dry_run=False)
CRUMBS = "<nav id=breadcrumb><ol class=fr-breadcrumb__list>" + "".join(f"<li><a href=#>{i}</a>" for i in range(7)) + "<li><a href=#>2023</a></ol></nav>"


def listing(links, following=None, year=True):
    cards = "".join(f"<div><a class=fr-card__link href='{x}'>p</a></div>" for x in links)
    more = f"<a class=fr-pagination__link--next href='{following}'>n</a>" if following else ""
    return f"{CRUMBS if year else ''}<div id=contenu><div class=liste-articles>{cards}</div><ul class=fr-pagination__list><li>{more}</ul></div>"


def project(title, *links):
    head = f"<h1 class=titre-article>{title}</h1>" if title else ""
    files = "".join(f"<div class=fr-download><a class=fr-download__link href='{u}'>{t}</a></div>" for u, t in links)
    return f"{head}<div id=contenu>{files}</div>"


PAGES = {
    "start": "<div id=contenu><div class=rubrique_avec_sous-rubriques><div class=fr-collapse><a class=lien-sous-rubrique href=dep>Ain (01)</a></div></div></div>",
    "dep": "<div id=contenu><div class=liste-rubriques><div><div class=item-liste-rubriques-seule><a class=fr-tile__link href='list?b=2&a=1'>2023</a></div></div>"
           "<div><div class=item-liste-rubriques-seule><a class=fr-tile__link href='old'>2019</a></div></div></div></div>",
    "list?a=1&b=2": listing(["p1", "p2", "gone"], "list2"), "list2": listing(["p3"], "list3", year=False), "list3": listing(["p4"]),
    "old": listing(["p5"]),
    "p1": project("One", ("a.pdf", "A"), ("b.pdf", ""), ("c.pdf", "C"), ("a.pdf#x", "again")),
    "p2": project(None, ("d.pdf", "D")), "p3": project("Three", ("e.pdf", "E")), "p4": project("Four", ("f.pdf", "F")),
    "p5": project("Five", ("g.pdf", "G")),
}


def site(spark):
    pages = spark.createDataFrame([(SITE + u, h) for u, h in PAGES.items()], "url string, html string")
    headers = spark.createDataFrame([(SITE + u, SITE + u, "Mon, 06 May 2024 07:08:09 GMT") for u in ("a.pdf", "b.pdf", "d.pdf")], schema.FILE_HEADERS)
    return pages, headers, spark.createDataFrame([], "zip_url string, member_path string"), spark.createDataFrame([], schema.SEEN)


def test_what_a_walk_loses(spark):
    pages, headers, _, seen = site(spark)
    walked = W.walk_all(pages, SITE + "start", PARAMS)
    assert {(r["source_file_url"][len(SITE):], r[D.DROP]) for r in walked.files.collect()} == {
        ("a.pdf", None), ("b.pdf", "No link text"), ("c.pdf", None), ("d.pdf", "Empty project")}
    files, lost = site_files(pages, headers, seen, SITE + "start", PARAMS)
    assert [r["source_file_url"] for r in files.collect()] == [SITE + "a.pdf"]
    assert {(r["url"][len(SITE):], r["reason"]) for r in lost.collect()} == {
        ("list2", "No year"), ("gone", "Page not captured"), ("b.pdf", "No link text"), ("d.pdf", "Empty project"), ("c.pdf", "No header")}


def test_only_reached_projects_are_parsed(spark, monkeypatch):
    parsed = []
    hits = W.X.page_hits

    def seen_hits(pages, kinds):
        parsed.append((kinds, sorted(r["url"][len(SITE):] for r in pages.select("url").collect())))
        return hits(pages, kinds)

    monkeypatch.setattr(W.X, "page_hits", seen_hits)
    W.walk(site(spark)[0], SITE + "start", PARAMS)
    assert parsed[1] == (W.DETAILS, ["p1", "p2"])


def test_site_run_keeps_losses_and_counts(spark):
    pages, headers, members, _ = site(spark)
    root = scratch_path(spark, "site")
    assert published_documents(spark, root).collect() == []
    assert not site_run(pages, headers, members, replace(PARAMS, dry_run=True), root, 0, SITE + "start")
    assert site_run(pages, headers, members, PARAMS, root, 0, SITE + "start")
    assert not site_run(pages, headers, members, PARAMS, root, 0, SITE + "start")
    assert site_run(pages, headers, members, PARAMS, root, 1, SITE + "start")
    assert [(r["batch"], r["title"], r["project"]) for r in published_documents(spark, root).collect()] == [(0, "A", "One")]
    runs = {r["batch_id"]: (r["accepted"], r["dropped"]) for r in store.committed_batches(spark, root).collect()}
    lost = {"No year": 1, "Page not captured": 1, "No link text": 1, "Empty project": 1, "No header": 1}
    assert runs == {0: (1, lost), 1: (0, lost)}
    assert spark.read.parquet(f"{root}/published/source=batch/batch=0/lost").count() == 5


def test_path_keys_sort_as_paths(spark):
    r = random.Random(1)
    paths = [[r.choice([0, 1, 2, 255, 256, 70_000]) for _ in range(r.randint(0, 5))] for _ in range(300)]
    df = spark.createDataFrame([(p,) for p in paths], "path array<int>").withColumn("key", path_key(F.col("path")))
    assert [x["path"] for x in df.orderBy("key").collect()] == sorted(paths)


@pytest.mark.parametrize("same", [
    ["http://A.example/", "http://a.example", "HTTP://a.example:80/#x", "http://a.example:?"],
    ["https://a.example:443/x?b=1&a=2", "https://a.example/x?a=2&b=1&", "https://a.example/x?a=%32&&b=1"],
    ["http://a.example/%7eu/%c3%a9%2f", "http://a.example/~u/é%2F"],
    ["http://a.example/a b?q=x y", "http://a.example/a%20b?q=x+y", "http://a.example/a%20b?q=x%20y"],
    ["http://a.example/?k", "http://a.example?k="], ["http://u:P@A.example/%", "http://u:P@a.example/%25"],
    ["mailto:X@y", "mailto:X@y#z"], ["", "#top"], [None],
])
def test_requests_that_are_the_same(evaluate, same):
    got = evaluate(request_identity, same)
    assert len(set(got)) == 1
    assert evaluate(request_identity, got) == got


def test_requests_that_differ(evaluate):
    urls = ["http://a.example/", "https://a.example/", "http://a.example:443/", "http://a.example/a", "http://a.example/A", "http://a.example/a/",
            "http://a.example/a%2Fb", "http://a.example/a/b", "http://a.example/?a=1&a=2", "http://a.example/?a=1", "http://U@a.example/"]
    assert len(set(evaluate(request_identity, urls))) == len(urls)
    assert set(evaluate(lambda c: request_identity(c, "HEAD"), urls)).isdisjoint(evaluate(request_identity, urls))


def test_known_archives_are_not_read(spark, tmp_path):
    for name, size in (("known.zip", 50_000), ("new [1] é.zip", 10), ("sub/other.ZIP", 10)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("x.pdf", b"y" * size)
    listed = {r["zip_url"] for r in pages_src.read_zips(spark, str(tmp_path)).select("zip_url").collect()}
    known = next(u for u in listed if u.endswith("known.zip"))
    seen = spark.createDataFrame([("zips", known, "", "", ""), ("documents", sorted(listed - {known})[0], "", "", "")], schema.SEEN)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "10000")  # reading a longer file fails
    try:
        with pytest.raises(Exception, match="exceeds the max length"):
            pages_src.zip_members(pages_src.read_zips(spark, str(tmp_path))).collect()
        got = pages_src.zip_members(pages_src.fresh_zips(spark, str(tmp_path), seen)).collect()
        assert {r["zip_url"] for r in got} == listed - {known} and len(got) == 2
        everything = spark.createDataFrame([("zips", u, "", "", "") for u in listed], schema.SEEN)
        assert pages_src.fresh_zips(spark, str(tmp_path), everything).collect() == []
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_projects_are_created_once(spark):
    root = scratch_path(spark, "registry")
    service = spark.createDataFrame([(7, "Known"), (3, "Known"), (5, "Other")], "id long, title string")
    ask = lambda *names: spark.createDataFrame([(n,) for n in names], "project string")
    rows = lambda df: {tuple(r) for r in df.collect()}
    first = {("Known", 3, False), ("12", 12, False), ("b", 9, True), ("a", 8, True)}
    assert rows(registry.allocate_projects(ask("b", "Known", "12", "a", "a"), service, root, 0)) == first
    assert rows(registry.allocate_projects(ask("c", "a"), service, root, 1)) == {("a", 8, False), ("c", 10, True)}
    assert rows(registry.allocate_projects(ask("b", "Known", "12", "a", "a"), service, root, 0)) == first
    # an allocation that died before its commit gives its ids anew
    spark.createDataFrame([("lost", 11)], schema.REGISTRY).write.parquet(f"{root}/registry/projects/allocation=2")
    assert rows(registry.allocate_projects(ask("d"), service, root, 2)) == {("d", 11, True)}
    assert rows(registry.created_projects(spark, root)) == {("a", 8, 0), ("b", 9, 0), ("c", 10, 1), ("d", 11, 2)}


@pytest.fixture(scope="module")
def archive_rows(spark):
    files = [(n, None, f"Project {n}", SITE + "p", SITE + (f"z{n}.zip" if n % 2 else f"f{n}.pdf"), "Mon, 06 May 2024 07:08:09 GMT" if n % 5 else "?",
              "Préfet", "cas par cas", "2023", "Ain (01)") for n in range(12)]
    files = [(r[0], "t", *r[2:]) for r in files]
    members = [(SITE + f"z{n}.zip", f"d/{m}.{'exe' if m == 3 else 'pdf'}") for n in range(1, 12, 2) for m in range(n)]
    return spark.createDataFrame(files, schema.DOCUMENTS_IN), spark.createDataFrame(members, "zip_url string, member_path string")


def test_progress_finishes_the_same_archives(spark, archive_rows):
    files, members = archive_rows
    root = scratch_path(spark, "progress")
    params = RunParams(project="x", upload_limit=7, run_ts=TS, dry_run=False)
    old = [("documents", SITE + "z7.zip/d/0.pdf", "", "", "")]
    store.write_seen(spark.createDataFrame(old, schema.SEEN), root, -1)
    store.commit_batch(spark, root, -1, "r", TS, 0)
    finished = 0
    for batch in range(6):
        seen = store.read_seen(spark, root)
        rows = classify(new_rows(files, members, seen), params)
        want = {r[0] for r in J.complete_zips(D.kept(rows), members, seen, params.supported_extensions).collect()}
        dropped = {r["reason"]: r["n"] for r in P.drop_counts(rows).collect()}
        accepted = D.kept(rows).count()
        run_monitor(files, members, params, root, batch)
        got = store.read_seen(spark, root).join(seen, "key", "left_anti").where("kind = 'zips'")
        assert {r["key"] for r in got.collect()} == want
        run = store.committed_batches(spark, root).where(F.col("batch_id") == batch).first()
        assert (run["accepted"], run["dropped"]) == (accepted, dropped)
        finished += len(want)
    assert finished == 5  # one archive has no date


def test_state_as_of_a_time(spark, archive_rows):
    files, members = archive_rows
    root, states = scratch_path(spark, "as-of"), {}
    day = dt.timedelta(days=1)
    keys = lambda df: {(r["kind"], r["key"]) for r in df.collect()}
    assert keys(store.read_seen_as_of(spark, root, TS)) == set()
    for batch in range(4):
        run_monitor(files.where(f"crawl_seq < {3 * batch + 3}"), members, RunParams(project="x", run_ts=TS + batch * day, dry_run=False), root, batch)
        states[batch] = keys(store.read_seen(spark, root))
        if batch in (1, 2):
            store.compact_seen(spark, root, 2)
    assert len(states[3]) > len(states[2]) > len(states[1]) > len(states[0]) > 0
    for batch, state in states.items():
        assert keys(store.read_seen_as_of(spark, root, TS + batch * day)) == state
    assert keys(store.read_seen_as_of(spark, root, TS - day)) == set()
