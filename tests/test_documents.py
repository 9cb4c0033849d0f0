"""Row transforms, limits, state and whole runs on small tables."""

import datetime as dt
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from docmonitor import RunParams, schema
from docmonitor.operators import documents as D, files as J, navigate as N, publish as P, state as S
from docmonitor.plans.documents import classify, document_records
from docmonitor.plans.monitor import new_rows, plan_run, published_documents, run_monitor
from docmonitor.sources import pages as pages_src, sinks, state as store
from docmonitor.streaming.monitor import stream_monitor

DATE = "Mon, 05 Feb 2024 10:11:12 GMT"
TS = dt.datetime(2024, 3, 1, 12, 0, 0)
SITE = "https://a.fr/"


def params(**kw):
    return RunParams(project="p", from_year=2024, to_year=2024, run_ts=TS, **{"dry_run": False, **kw})


def files_table(spark, names, **changes):
    base = {
        "title": "avis", "project": "parc (38)", "source_page_url": SITE + "p.html",
        "publication_lastmodified": DATE, "authority": "Préfecture", "year": "2024",
        "category_local": "cas par cas", "department_label": "Isère (38)", **changes,
    }
    rows = [{"crawl_seq": i, "source_file_url": SITE + n, **base} for i, n in enumerate(names)]
    order = schema.DOCUMENTS_IN.fieldNames()
    return spark.createDataFrame([tuple(r[c] for c in order) for r in rows], schema.DOCUMENTS_IN)


def members_table(spark, *pairs):
    return spark.createDataFrame([(SITE + z, m) for z, m in pairs], "zip_url string, member_path string")


def empty_seen(spark):
    return spark.createDataFrame([], schema.SEEN)


def col(df, name):
    return sorted(r[0] for r in df.select(name).collect())


@pytest.mark.parametrize("authority, project, departments, sources", [
    ("plain", "X", "38", "scraper"), ("plain", "X (38)", "38", "scraper"),
    ("plain", "X (38-73)", "38,73", "scraper,regex"), ("de Mayotte", "X (73)", "38,976", "scraper,authority"),
    ("plain", "X région Corse", "2A,2B,38", "scraper,regex"), ("plain", "X (Ain)", "01,38", "scraper,regex"),
])
def test_tagging(spark, authority, project, departments, sources):
    df = spark.createDataFrame([("38", authority, project)],
                               "department_from_scraper string, authority string, project string")
    row = D.tag_departments(df).first()
    assert (",".join(row.departments), ",".join(row.departments_sources)) == (departments, sources)
    assert len(row) == 5


def test_drop_reasons(spark):
    def reason(name="a.pdf", **changes):
        df = J.as_plain_docs(files_table(spark, [name], **changes))
        return classify(df, params()).first()[D.DROP]

    assert reason() is None
    assert reason(department_label="Corse (2A)") == "No department code"
    assert reason(publication_lastmodified=None) == "Bad Last-Modified"
    assert reason(publication_lastmodified="hier") == "Bad Last-Modified"
    assert reason(project=" .,") == "Empty project"
    assert reason(project=None) == "Empty project"
    assert reason(title="_") == "Empty title"
    assert reason("a.exe") == "Unsupported filetype"
    assert reason("a.exe", title=None) == "Empty title"
    assert reason(category_local="Avis") == "No category"
    assert reason(category_local=None) == "No category"
    assert reason(source_page_url=None) == "No page URL"
    assert reason(authority=None) == "No authority"


@pytest.mark.parametrize("n, kept", [(0, 5), (3, 3), (6, 5), (9, 5)])
@pytest.mark.parametrize("rows_per_range", [1, 10**6])
def test_limit(spark, monkeypatch, n, kept, rows_per_range):
    monkeypatch.setattr(D, "ROWS_PER_RANGE", rows_per_range)
    df = J.as_plain_docs(files_table(spark, ["a.pdf", "b.exe", "c.pdf", "d.pdf", "e.pdf", "f.pdf"]))
    rows = classify(df, params(upload_limit=n))
    accepted = col(D.kept(rows), "crawl_seq")
    assert accepted == [0, 2, 3, 4, 5][:kept]
    assert rows.count() == 6 and D.dropped(rows).count() == 6 - kept
    reasons = {r.reason: (r.n, r.quiet) for r in P.drop_counts(rows).collect()}
    assert reasons["Unsupported filetype"] == (1, False)
    assert reasons.get("Upload limit exceeded.", (0, True)) == (5 - kept, True)


def test_late_failures_count_towards_the_limit(spark):
    df = J.as_plain_docs(files_table(spark, ["a.pdf"], category_local="Avis")).unionByName(
        J.as_plain_docs(files_table(spark, ["x.pdf", "b.pdf"]).where("crawl_seq = 1")))
    assert document_records(df, params(upload_limit=1)).count() == 0


def test_global_rank(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    ranked = D.global_rank(df, "k")
    assert ranked.where("rank = k + 1").count() == 1000


def test_dedupe_keeps_the_first_of_a_hot_key(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("u"))
    first = N.dedupe_requests(df, "u", "id")
    assert first.count() == 2001 and first.where("u = 'hot'").first().id == 0
    assert "WindowGroupLimit" in first._jdf.queryExecution().toString()


def test_not_seen(spark):
    files = files_table(spark, ["a.pdf", "b.pdf", "z.zip", "y.zip"]).select("source_file_url")
    seen = spark.createDataFrame([
        ("documents", SITE + "a.pdf", "", "", ""), ("zips", SITE + "b.pdf", "", "", ""),
        ("zips", SITE + "z.zip", "", "", ""), ("documents", SITE + "y.zip", "", "", ""),
    ], schema.SEEN)
    assert col(J.not_seen(files, seen), "source_file_url") == []
    assert col(J.not_seen_final(files, seen), "source_file_url") == [SITE + "b.pdf", SITE + "y.zip"]


@pytest.mark.parametrize("seen, accepted, complete", [
    ([], ["a.pdf", "b.pdf"], True), (["a.pdf"], ["b.pdf"], True), ([], ["a.pdf"], False),
    (["a.pdf", "b.pdf"], [], False),
])
def test_completeness(spark, seen, accepted, complete):
    members = members_table(spark, ("z.zip", "a.pdf"), ("z.zip", "b.pdf"), ("z.zip", "c.exe"))
    state = spark.createDataFrame(
        [("documents", f"{SITE}z.zip/{m}", "", "", "") for m in seen], schema.SEEN)
    done = spark.createDataFrame(
        [(f"{SITE}z.zip/{m}", SITE + "z.zip", True) for m in accepted],
        "event_data_key string, source_file_url string, file_from_zip boolean")
    assert J.complete_zips(done, members, state, (".pdf",)).count() == int(complete)


def test_archive_without_supported_files_is_never_complete(spark):
    members = members_table(spark, ("z.zip", "c.exe"))
    assert plan_run(files_table(spark, ["z.zip"]), members, empty_seen(spark), params()).new_state.isEmpty()


def run_twice_inputs(spark):
    files = files_table(spark, ["a.pdf", "z.zip", "b.exe", "c.pdf", "a.pdf"])
    members = members_table(spark, ("z.zip", "d/m1.pdf"), ("z.zip", "m2.PDF"), ("z.zip", "m3.exe"))
    return files, members


def test_second_run_accepts_nothing(spark, tmp_path):
    files, members = run_twice_inputs(spark)
    root = str(tmp_path)
    assert run_monitor(files, members, params(export_state=True), root, 0)
    seen = store.read_seen(spark, root)
    assert sorted((r.kind, r.key.removeprefix(SITE)) for r in seen.collect()) == [
        ("documents", "a.pdf"), ("documents", "c.pdf"), ("documents", "z.zip/d/m1.pdf"),
        ("documents", "z.zip/m2.PDF"), ("zips", "z.zip")]
    assert {r.last_modified for r in seen.collect()} == {"2024-02-05T10:11:12"}
    exported = store.load_seen(spark, f"{root}/export/event_data_20240301_1200")
    assert sorted(map(tuple, exported.collect())) == sorted(map(tuple, seen.collect()))
    assert not run_monitor(files, members, params(), root, 0)  # the same batch: skipped
    assert run_monitor(files, members, params(), root, 1)
    assert store.committed_batches(spark, root).where("batch_id = 1").first().accepted == 0
    assert published_documents(spark, root).count() == 4
    titles = col(published_documents(spark, root).where("file_from_zip"), "title")
    assert titles == ["D - m1", "M2"]


def test_limited_archive_is_finished_by_the_next_run(spark, tmp_path):
    files, members = run_twice_inputs(spark)
    root = str(tmp_path)
    run_monitor(files, members, params(upload_limit=2), root, 0)
    assert store.read_seen(spark, root).where("kind = 'zips'").isEmpty()
    run_monitor(files, members, params(upload_limit=2), root, 1)
    assert store.read_seen(spark, root).where("kind = 'zips'").count() == 1
    assert published_documents(spark, root).count() == 4


def test_dry_run_writes_nothing(spark, tmp_path):
    files, members = run_twice_inputs(spark)
    assert not run_monitor(files, members, params(dry_run=True), str(tmp_path), 0)
    assert list(tmp_path.iterdir()) == []
    assert RunParams(project="p").dry_run


def test_an_uncommitted_run_is_repeated(spark, tmp_path):
    files, members = run_twice_inputs(spark)
    root = str(tmp_path)
    stale = plan_run(files, members, empty_seen(spark), params()).new_state
    store.write_seen(stale, root, 0)  # died before its manifest row
    assert store.read_seen(spark, root).isEmpty()
    run_monitor(files, members, params(), root, 0)
    assert store.read_seen(spark, root).count() == 5


def test_stream_equals_batch(spark, tmp_path):
    files, members = run_twice_inputs(spark)
    one, many, arriving = (str(tmp_path / n) for n in ("one", "many", "in"))
    run_monitor(files, members, params(), one, 0)
    for i in range(5):
        files.where(F.col("crawl_seq") == i).coalesce(1).write.mode("append").parquet(arriving)
    stream = pages_src.stream_pages(spark, arriving, schema.DOCUMENTS_IN, maxFilesPerTrigger=1)
    stream_monitor(stream, members, params(), many, clock=lambda: TS).awaitTermination()
    assert store.committed_batches(spark, many).count() == 5
    as_set = lambda root: sorted(map(tuple, store.read_seen(spark, root).collect()))
    assert as_set(one) == as_set(many)
    # nothing new: the stream has nothing to do
    stream = pages_src.stream_pages(spark, arriving, schema.DOCUMENTS_IN, maxFilesPerTrigger=1)
    stream_monitor(stream, members, params(), many).awaitTermination()
    assert as_set(one) == as_set(many)


def test_compaction_keeps_state_ids_and_publications(spark, tmp_path):
    files, members = run_twice_inputs(spark)
    root = str(tmp_path)
    state = lambda: sorted(map(tuple, store.read_seen(spark, root).collect()))
    run_monitor(files.where("crawl_seq < 1"), members, params(), root, 0)
    run_monitor(files.where("crawl_seq < 2"), members, params(), root, 1)
    before, published = state(), published_documents(spark, root).count()
    for _ in range(2):
        store.compact_seen(spark, root, 2)
        assert state() == before
        assert published_documents(spark, root).count() == published
        assert not run_monitor(files, members, params(), root, 1)  # a replay is still known
    assert run_monitor(files, members, params(), root, 2)
    assert len(state()) == 5 and set(before) < set(state())
    store.compact_seen(spark, root, 1)
    assert len(state()) == 5


def test_stream_after_a_batch_run_loses_nothing(spark, tmp_path):
    files, members = run_twice_inputs(spark)
    root, arriving = str(tmp_path / "root"), str(tmp_path / "in")
    run_monitor(files.where("crawl_seq < 1"), members, params(), root, 0)
    times = iter([TS + dt.timedelta(minutes=m) for m in range(1, 9)])

    def arrive(*numbers):
        for i in numbers:
            files.where(F.col("crawl_seq") == i).coalesce(1).write.mode("append").parquet(arriving)
            stream = pages_src.stream_pages(spark, arriving, schema.DOCUMENTS_IN, maxFilesPerTrigger=1)
            stream_monitor(stream, members, params(), root, clock=lambda: next(times)).awaitTermination()

    arrive(1, 2)
    os.rename(f"{root}/stream", f"{root}/stream-lost")  # a renewed checkpoint counts from 0 again
    arrive(3, 4)
    assert store.read_seen(spark, root).count() == 5
    runs = store.committed_batches(spark, root)
    assert runs.select("source").distinct().count() == 3
    stamps = [r.run_ts for r in runs.where("source <> 'batch'").collect()]
    assert len(set(stamps)) == len(stamps) > 3
    assert store.read_seen(spark, root).select("last_seen").distinct().count() > 1


def test_a_replay_has_the_time_of_its_first_start(spark, tmp_path):
    first = store.started_at(spark, str(tmp_path), 3, "s", TS)
    assert store.started_at(spark, str(tmp_path), 3, "s", TS + dt.timedelta(hours=1)) == first == TS
    assert store.started_at(spark, str(tmp_path), 3, "t", TS + dt.timedelta(hours=1)) != TS


def test_source_names(spark, tmp_path):
    for bad in ("", "a/b", "compaction", "x=y"):
        with pytest.raises(ValueError):
            store.check_source(bad)


def test_upserts_replace_old_entries(spark):
    seen = spark.createDataFrame([("documents", SITE + "a.pdf", "old", "old", "old"),
                                  ("zips", SITE + "a.pdf", "z", "z", "z")], schema.SEEN)
    accepted = document_records(J.as_plain_docs(files_table(spark, ["a.pdf", "b.pdf"])), params())
    rows = {(r.kind, r.key): r.last_seen for r in S.upsert_documents(seen, accepted, TS).collect()}
    assert rows == {("documents", SITE + "a.pdf"): "2024-03-01T12:00:00", ("zips", SITE + "a.pdf"): "z",
                    ("documents", SITE + "b.pdf"): "2024-03-01T12:00:00"}


def test_load_seen(spark, tmp_path):
    whole = tmp_path / "s.json"
    whole.write_text('{"documents": {"u": {"last_modified": "a", "last_seen": "b", "target_year": "2024"}}, "zips": {"v": {"last_modified": "c"}}}')
    assert sorted(map(tuple, store.load_seen(spark, str(whole)).collect())) == [
        ("documents", "u", "a", "b", "2024"), ("zips", "v", "c", None, None)]
    missing, broken = str(tmp_path / "none.json"), tmp_path / "b.json"
    broken.write_text('{"documents": {"u": {"last_modified": "a"}}}\n{nonsense')
    assert store.load_seen(spark, missing, dry_run=True).isEmpty()
    assert store.load_seen(spark, str(broken), dry_run=True).isEmpty()
    with pytest.raises(Exception):
        store.load_seen(spark, missing)
    with pytest.raises(Exception):
        store.load_seen(spark, str(broken)).collect()


def test_bucketed_state_is_not_shuffled(spark):
    seen = spark.createDataFrame([("documents", SITE + "a.pdf", "", "", "")], schema.SEEN)
    store.save_seen_table(seen, "seen_bucketed", 4)
    files = files_table(spark, ["a.pdf", "b.pdf"]).select("source_file_url")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = J.not_seen(files, spark.table("seen_bucketed"))
        assert left._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert col(left, "source_file_url") == [SITE + "b.pdf"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.sql("DROP TABLE seen_bucketed")


def test_zip_sources(spark, tmp_path):
    (tmp_path / "x").mkdir()
    for folder, name in ((tmp_path, "same.zip"), (tmp_path / "x", "same.zip")):
        with zipfile.ZipFile(folder / name, "w") as z:
            z.writestr("dossier/", "")
            z.writestr("dossier/a.PDF", "12345")
            z.writestr("/../up/b.exe", "1")
            z.writestr("dossier/a.PDF", "123")
    with zipfile.ZipFile(tmp_path / "EMPTY.ZIP", "w"):
        pass
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    (tmp_path / "other.txt").write_text("x")
    zips = pages_src.read_zips(spark, str(tmp_path))
    rows = [(r.zip_url.split("/")[-2] == "x", r.pos, r.member_path, r.size)
            for r in pages_src.zip_members(zips).collect()]
    assert sorted(rows) == [(x, *m) for x in (False, True)
                            for m in ((0, "dossier/a.PDF", 3), (1, "up/b.exe", 1))]
    assert [r.zip_url.split("/")[-1] for r in pages_src.unreadable_zips(zips).collect()] == ["bad.zip"]
    headers = pages_src.headers_of_files(spark, str(tmp_path), "*.txt")
    assert D.parse_http_date(headers.withColumnRenamed("last_modified", "publication_lastmodified")).where(
        "publication_ts IS NOT NULL").count() == 1


def test_feed_report_and_records(spark, tmp_path):
    files, members = run_twice_inputs(spark)
    rows = new_rows(files, members, empty_seen(spark))
    docs = document_records(rows, params(run_name="n", run_id="7", access_level="public"))
    sinks.write_items_csv(docs, str(tmp_path / "feed"))
    feed = spark.read.option("header", True).csv(str(tmp_path / "feed"))
    assert feed.columns == list(schema.FEED_COLUMNS) and feed.count() == 4
    report = P.run_report(docs, params(run_name="n", run_id="7")).first()
    assert report.subject == "Document monitor 2024 (New: 4) [n]"
    assert report.heading == "Document monitor Run 7\n\nSCRAPED ITEMS (4)"
    item = P.report_items(docs.where("NOT file_from_zip").limit(1)).first().item_text
    assert item.count("\n") == 12 and item.startswith("\n            title: Avis\n")
    sinks.write_report(P.run_report(docs, params()), P.report_items(docs), str(tmp_path / "report"))
    record = P.to_publish_records(docs.where("file_path IS NULL" if "file_path" in docs.columns else "file_from_zip"), params()).first()
    assert "source_file_zip_path" in record.data and record.original_extension == "pdf"
    plain = P.to_publish_records(docs.where("NOT file_from_zip"), params()).first()
    assert "source_file_zip_path" not in plain.data
    sinks.write_publish(P.to_publish_records(docs, params()), str(tmp_path / "records"))
    assert (tmp_path / "records" / "year=2024").is_dir()


def test_params():
    assert RunParams(from_year=2023, to_year=2024).year_label == "2023-2024"
    assert params().year_label == "2024" and params().source_scraper.endswith("2024-2024")
    for bad in ({"access_level": "secret"}, {"from_year": 2025, "to_year": 2024}, {"upload_limit": -1}):
        with pytest.raises(ValueError):
            RunParams(**bad)


def test_projects(spark):
    asked = spark.createDataFrame([("12",), ("known",), ("b new",), ("a new",), ("a new",)], "project string")
    known = spark.createDataFrame([(40, "known"), (41, "other")], "id long, title string")
    rows = {r.project: (r.project_ref, r.created) for r in S.resolve_project(asked, known).collect()}
    assert rows == {"12": (12, False), "known": (40, False), "a new": (42, True), "b new": (43, True)}


def test_session_must_be_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError):
            classify(J.as_plain_docs(files_table(spark, ["a.pdf"])), params())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
