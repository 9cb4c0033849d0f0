"""Steps that must grow with their input only: archives, the state's JSON, parsed pages, test inputs."""

import io
import random
import warnings
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import views as V
from docmonitor.functions import archives as A
from docmonitor.functions import html as H
from docmonitor.operators import extract as X
from docmonitor.sources import state as store


def paths_of(seed):
    draw = random.Random(seed)
    names = ("dossier_1/piece_2.pdf", "x", "a//b/../c", "d/", "/", "é.pdf", "nul\0l.pdf")
    return ["vide/", *(draw.choice(names) for _ in range(draw.randrange(6)))]


@pytest.mark.parametrize("seed", range(40))
def test_archives_are_written_and_listed_as_zipfile_does(seed):
    warnings.simplefilter("ignore")
    paths = paths_of(seed)
    content = V._zip_bytes(paths)
    assert content == V._slow_zip_bytes(paths)
    plain = A._plain_entries(memoryview(content))
    assert (plain is None) == any(not p.isascii() for p in paths)
    assert plain is None or plain == A._entries(memoryview(content))


def test_unusual_archives_are_left_to_zipfile():
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        z.writestr("a.pdf", "1")
    good = body.getvalue()
    with zipfile.ZipFile(body, "a") as z:
        z.comment = b"note"
    for content in (b"", b"x" * 30, good[:-1], good + b"z", b"zz" + good, body.getvalue()):
        assert A._plain_entries(memoryview(content)) is None
    listed = A._listings(pa.array([good, None, b"no", b"zz" + good, body.getvalue()], pa.binary())).to_pylist()
    member = [{"pos": 0, "member_path": "a.pdf", "size": 1}]
    assert [r["members"] for r in listed] == [member, [], [], member, member]
    assert [r["error"] for r in listed] == [None, "File is not a zip file", "File is not a zip file", None, None]


def test_archive_views_shuffle_the_lines_once(spark):
    lines = V.zip_files(spark, "/root/testdata/sf0.001")
    assert lines._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_state_is_read_once_for_both_kinds(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"documents": {"u": {"last_modified": "a"}}, "zips": {"v": {}, "w": null}}\n{}\n')
    seen = store.load_seen(spark, str(tmp_path / "s.json"))
    assert seen._jdf.queryExecution().executedPlan().toString().count("FileScan json") == 1
    assert sorted((r.kind, r.key, r.last_modified) for r in seen.collect()) == [
        ("documents", "u", "a"), ("zips", "v", None), ("zips", "w", None)]


def test_pages_without_wanted_elements_are_not_parsed(monkeypatch, spark):
    project = '<h1 class=titre-article>n&deg; 1</h1>'
    coded = "<div id=contenu><div class='fr-download'><a class='fr-download&#95;_link' href=a.pdf>A</a></div></div>"
    parsed = []
    monkeypatch.setattr(H, "_page_hits", lambda page, url: parsed.append(url) or [])
    H._hit_lists([project, coded, None, "&", coded], ["p", "c", "n", "e", "d"], [H.MARKERS["download"]])
    assert parsed == ["c", "d"]
    monkeypatch.undo()
    pages = spark.createDataFrame([(f"https://a.fr/{i}", project if i % 3 else coded) for i in range(600)], "url string, html string").coalesce(1)
    assert X.page_hits(pages, ("download",)).count() == 200
    assert X.page_hits(pages).groupBy("kind").count().orderBy("kind").collect() == [("download", 200), ("title", 400)]


def test_a_batch_of_pages_is_turned_into_rows_in_parts(monkeypatch):
    sizes = []
    parts = H._hit_lists
    monkeypatch.setattr(H, "_hit_lists", lambda pages, *rest: sizes.append(len(pages)) or parts(pages, *rest))
    page = "<h1 class=titre-article>x</h1>"
    hits = H._hits_udf.__wrapped__(("title",)).func(pa.array([page] * 1000), pa.array(["u"] * 1000))
    assert max(sizes) <= H.PAGES_AT_ONCE and sum(sizes) == 1000
    assert [len(h) for h in hits.to_pylist()] == [1] * 1000


def test_members_of_an_order_that_comes_twice(spark, tmp_path):
    orders = spark.range(1).select(
        F.lit(2).cast("long").alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), F.lit("1996-01-01").cast("timestamp").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))
    orders.union(orders).write.parquet(f"{tmp_path}/orders.parquet")
    line = spark.range(1).select(F.lit(2).cast("long").alias("l_orderkey"), F.lit(4).cast("long").alias("l_partkey"), F.lit(1).alias("l_linenumber"))
    line.union(line).write.parquet(f"{tmp_path}/lineitem.parquet")
    members = V.members_in(spark, str(tmp_path))
    assert members.count() == 2  # one line, two orders
    assert V.seen_in(spark, str(tmp_path), members).count() == V.seen_in(spark, str(tmp_path)).count() == 4
