import gzip
import hashlib
import types

import pyarrow as pa
import pytest
from pyarrow import fs

from docmonitor.llm import common, warc
from docmonitor.session import scratch_path

BIG = "<p>" + "same page " * 40
PAGES = [
    (5, "http://a", BIG), (3, "http://b", BIG), (9, "http://c", BIG), (None, "http://d", BIG), (1, "http://e", "small"),
    (2, "http://f", "small"), (4, None, None), (6, "http://g\r\nX: 1", ""), (7, "http://h", "é" * 50), (8, "http://i", "é" * 50),
    (10, "http://j", "e" * 99), (11, "http://k", "e" * 99), (12, "http://l", "z" * 300_000), (12, "http://l", "z" * 300_000),
]
SCHEMA = "page_id long, url string, html string, payload string, record_type int"


@pytest.fixture(scope="module")
def pages(shared):
    return shared.createDataFrame([(*p, "x", 1) for p in PAGES], SCHEMA).repartition(3)


def read(pages, shared, split, file_bytes=warc.FILE_BYTES):
    manifest = warc.write_warc(warc.plan_records(pages), scratch_path(shared, "w"), file_bytes=file_bytes)
    return manifest, warc.read_warc(manifest, split).collect()


@pytest.mark.parametrize("split", [1, 37, 1000, 1 << 23])
def test_every_split_gives_every_record_once(shared, pages, split):
    _, rows = read(pages, shared, split, file_bytes=900)
    got = sorted((r["record_id"], r["payload_digest"], r["payload_bytes"], r["record_type"], r["refers_to"] or "") for r in rows)
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        same = [j for j, _, h in PAGES if (h or "") == (html or "") and j is not None]
        again = len(data) >= 100 and same and i != min(same)
        want.append((f"urn:page:{'' if i is None else i}", hashlib.sha256(data).hexdigest(), len(data),
                     "revisit" if again else "response", f"urn:page:{min(same)}" if again else ""))
    assert got == sorted(want)
    for r in rows:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        if r["payload"] is not None:
            assert hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"]


def test_files_are_plain_gzip(shared, pages):
    manifest, rows = read(pages, shared, 1 << 20)
    text = b"".join(gzip.open(r["path"]).read() for r in manifest.collect())
    assert text.count(b"WARC/1.1\r\n") == len(PAGES) == len(rows)
    assert b"\nX: 1" not in text


def test_magic_inside_a_member_is_no_record(tmp_path):
    """A stored (not deflated) member holds the magic, and even a whole gzip file that isn't WARC."""
    import random
    import zlib

    noise = gzip.compress(b"not a record") + warc.MAGIC * 5 + random.Random(1).randbytes(3000)
    members = []
    for k in range(4):
        packer = zlib.compressobj(0, zlib.DEFLATED, 31)
        members.append(packer.compress(warc.record(k, None, noise, len(noise), "d", "response", None, "x")) + packer.flush())
    (tmp_path / "f").write_bytes(b"".join(members))
    size = sum(map(len, members))
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "f")) as file:
        for split in (7, 500, size):
            found = [at for a in range(0, size, split) for at, _ in warc.members(file, size, a, min(size, a + split))]
            assert found == [sum(map(len, members[:k])) for k in range(4)]


def test_no_pages(shared, pages):
    assert read(pages.limit(0), shared, 100)[1] == []


def test_files_keep_the_scheme_of_their_folder(shared, pages):
    """Readers get whole addresses, so they open the store that was written to."""
    folder = scratch_path(shared, "w")
    folder = folder if "://" in folder or folder.startswith("file:") else "file://" + folder
    manifest = warc.write_warc(warc.plan_records(pages), folder)
    assert all(r["path"].startswith(folder + "/") for r in manifest.collect())
    assert warc.read_warc(manifest).count() == len(PAGES)


def test_stores_are_named_as_in_spark(monkeypatch):
    asked = []
    monkeypatch.setattr(common, "from_uri", lambda uri: asked.append(uri) or ("store", uri))
    for uri in ("s3a://b/x", "s3n://b/x", "s3://b/x", "hdfs://n:1/x", "gs://b/x"):
        common.open_folder(uri)
    assert asked == ["s3://b/x", "s3://b/x", "s3://b/x", "hdfs://n:1/x", "gs://b/x"]
    assert isinstance(common.open_folder("file:///a/b")[0], fs.LocalFileSystem) and common.open_folder("file:/a/b")[1] == "/a/b"
    assert common.open_folder("/a/b")[1] == "/a/b"


def test_another_store_than_the_local_one(monkeypatch, tmp_path):
    """What a writer's task puts into a store under a whole address, a reader's task finds there."""
    store = fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())
    monkeypatch.setattr(common, "from_uri", lambda uri: (store, uri.split("://")[1]))
    monkeypatch.setattr(warc, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    write = warc._writer("gs://bucket/warc", "1970-01-01T00:00:00Z", 1 << 20)
    rows = pa.RecordBatch.from_pylist([
        {"page_id": 1, "url": "u", "payload": b"abc", "payload_bytes": 3, "payload_digest": "d", "record_type": "response", "refers_to": None}])
    made = [r for b in write(iter([rows])) for r in b.to_pylist()]
    assert made[0]["path"].startswith("gs://bucket/warc/") and (tmp_path / "bucket" / "warc").is_dir()
    ranges = pa.RecordBatch.from_pylist([{"path": m["path"], "bytes": m["bytes"], "first": 0, "last": m["bytes"]} for m in made])
    assert [r["payload"] for b in warc._read_ranges(iter([ranges])) for r in b.to_pylist()] == [b"abc"]
