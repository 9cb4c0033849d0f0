"""WARC archives: a writer with revisit records, and a splittable reader.

A record is one gzip member.  The reader's tasks are byte ranges of the files: each
looks for the gzip magic, takes a place for a record only if a member that starts there
decodes to a WARC header, and owns the records that start inside its range, of which it
reads the last one past the range's end.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmonitor.llm.common import arrow_schema, one_task_each, open_folder, read_table, rows_of_all, small_batches
from docmonitor.session import materialise, scratch_path

MAGIC = b"\x1f\x8b\x08"
START = b"WARC/1."
RECORD_ID = "urn:page:"
LEAST_SHARED = 100
FILE_BYTES = 64 << 20
SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 20
SALTS = 32

MANIFEST = arrow_schema({"path": pa.string(), "bytes": pa.int64(), "records": pa.int64()})
RECORDS_DDL = ("path string, record_at long, record_type string, record_id string, target_uri string, "
               "refers_to string, payload_digest string, payload_bytes long, payload binary")
RECORDS = arrow_schema({
    "path": pa.string(), "record_at": pa.int64(), "record_type": pa.string(), "record_id": pa.string(),
    "target_uri": pa.string(), "refers_to": pa.string(), "payload_digest": pa.string(),
    "payload_bytes": pa.int64(), "payload": pa.binary(),
})


def plan_records(pages: DataFrame, least_shared: int = LEAST_SHARED) -> DataFrame:
    """Decides which pages are stored and which point to an equal payload.

    Of equal payloads of at least ``least_shared`` bytes, that with the smallest
    ``page_id`` is a response and the others are revisits of it.  A null html is an empty
    payload.  A null ``page_id`` is never the smallest; where all are null, or rows repeat
    the smallest, each of these is a response.  The one number per shared payload comes
    from an aggregate, which is joined back salted: a payload of a third of all pages meets
    the other pages in no single task.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    shared = (rows.where(F.col("payload_bytes") >= least_shared).groupBy("payload_digest")
              .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1 AND first_id IS NOT NULL")
              .select("payload_digest", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(shared, ["payload_digest", "salt"], "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", F.when(again, F.lit(None)).otherwise(F.col("payload")).alias("payload"),
        "payload_bytes", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"))


def record(page_id, url, payload, size, digest, kind, refers_to, date) -> bytes:
    """One record, not yet compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{RECORD_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + len(payload or b'')}",
    ]
    if url is not None:  # no line end may come into a header
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{RECORD_ID}{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + (payload or b"") + b"\r\n\r\n"


def write_warc(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z",
               file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes records, a gzip member each, into files under ``folder``; returns their manifest.

    A file is named anew in each attempt; only those of the attempts that count are in the
    manifest, a written table, so lost executors leave unused files and nothing else.  Nothing
    to write gives an empty manifest.  A payload is held whole, a few times over, in its task.
    """

    ordered = records.select("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return materialise(ordered.mapInArrow(_writer(folder, date, file_bytes), "path string, bytes long, records long"), "warc-files")


def _writer(folder: str, date: str, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        out, path, size, n = None, "", 0, 0
        for row in rows_of_all(batches):
            if out is None:
                name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                path = f"{folder}/{name}"  # with its scheme: readers open the same store
                out, size, n = fs.open_output_stream(f"{base}/{name}", compression=None), 0, 0
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = packer.compress(record(*row, date)) + packer.flush()
            out.write(member)
            size, n = size + len(member), n + 1
            if size >= file_bytes:
                out.close()
                out = None
                yield pa.RecordBatch.from_pylist([{"path": path, "bytes": size, "records": n}], schema=MANIFEST)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "bytes": size, "records": n}], schema=MANIFEST)

    return write


class Bytes:
    """A file read forward in blocks, from which what lies behind is dropped."""

    def __init__(self, file, at: int, size: int):
        self.file, self.at, self.size, self.data = file, at, size, b""

    def upto(self, end: int) -> None:
        """Have the bytes before ``end``, as far as the file has them."""
        have = self.at + len(self.data)
        if end > have:
            self.data += self.file.read_at(min(self.size, max(end, have + READ_BYTES)) - have, have)

    def drop(self, before: int) -> None:
        self.data, self.at = self.data[max(0, before - self.at):], max(self.at, before)


def member_at(source: Bytes, at: int) -> tuple[bytes, int] | None:
    """The decoded member that starts at ``at`` and its end, if it is a whole WARC record."""
    unpacker, parts, pos, n = zlib.decompressobj(31), [], at, 0
    try:
        while not unpacker.eof:
            source.upto(pos + 65536)
            chunk = source.data[pos - source.at: pos - source.at + 65536]
            if not chunk:
                return None
            got = unpacker.decompress(chunk)
            pos += len(chunk)
            parts.append(got)
            n += len(got)
            if n >= len(START) > n - len(got) and not b"".join(parts).startswith(START):
                return None
    except zlib.error:
        return None
    data = b"".join(parts)
    return (data, pos - len(unpacker.unused_data)) if data.startswith(START) else None


def members(file, size: int, first: int, last: int) -> Iterator[tuple[int, bytes]]:
    """The records that start in ``[first, last)``, with their places."""
    source, at = Bytes(file, first, size), first
    while at < last:
        source.drop(at)
        source.upto(min(last, at + READ_BYTES) + len(MAGIC) - 1)
        found = source.data.find(MAGIC)
        if found < 0:  # the magic may stand over the end of what was read
            at += max(1, len(source.data) - len(MAGIC) + 1)
            continue
        at += found
        if at >= last:
            return
        record = member_at(source, at)
        if record is None:
            at += 1
            continue
        yield at, record[0]
        at = record[1]


def headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def parse(path: str, at: int, data: bytes) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = headers(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    bare = lambda name: warc[name].strip("<>") if name in warc else None
    return {
        "path": path, "record_at": at, "record_type": warc["warc-type"], "record_id": bare("warc-record-id"),
        "target_uri": warc.get("warc-target-uri"), "refers_to": bare("warc-refers-to"),
        "payload_digest": warc["warc-payload-digest"].rpartition(":")[2],
        "payload_bytes": int(headers(http)["content-length"]),
        "payload": None if warc["warc-type"] == "revisit" else payload,
    }


def _read_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for path, size, first, last in rows_of_all(batches):
        fs, at = open_folder(path)
        with fs.open_input_file(at) as file:
            held, held_bytes = [], 0
            for place, data in members(file, size, first, last):
                held.append(parse(path, place, data))
                held_bytes += len(data)
                if held_bytes >= 4 << 20:
                    yield pa.RecordBatch.from_pylist(held, schema=RECORDS)
                    held, held_bytes = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=RECORDS)


def read_warc(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row a record of the archives.  A revisit has no payload of its own."""

    first = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    ranges = manifest.select("path", "bytes", first.alias("first")).select(
        "path", "bytes", "first", F.least(F.col("first") + split_bytes, F.col("bytes")).alias("last"))
    return one_task_each(ranges).mapInArrow(_read_ranges, RECORDS_DDL)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes ``pages`` as archives, reads them back and returns each record's description;
    sizes and digests of responses are taken from the payload that was read."""
    small_batches(spark)
    manifest = write_warc(plan_records(read_table(spark, sf_dir, "pages")), scratch_path(spark, "warc"))
    records = read_warc(manifest)
    number = lambda name: F.expr(f"try_cast(substring({name}, {len(RECORD_ID) + 1}) AS BIGINT)")
    stored = F.col("record_type") == "response"
    return records.select(
        number("record_id").alias("page_id"),
        F.when(stored, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(stored, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"))


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
  CASE WHEN f.first_id IS NULL OR d.page_id IS NOT DISTINCT FROM f.first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f.first_id IS NOT NULL AND d.page_id IS DISTINCT FROM f.first_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""
