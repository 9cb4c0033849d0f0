"""Token-id files as directly addressable codes.

An id is cut into chunks of eight bits, lowest first.  Level 0 holds the lowest chunk
of every id; a bitmap beside it says whose next chunk stands in level 1, and so on.
The k-th set bit of a bitmap belongs to the k-th chunk of the next level, and a rank
directory (set bits before each block of 512) turns that into an address.  So any
token is read with a few bytes a level, and nothing around it is decoded.

File: ``TOKDAC01``; for each level its chunks, bitmap and directory; the documents'
numbers (int64, with a null flag byte each) and first tokens; a footer of unsigned
64-bit integers with all places; its length; ``TOKDAC01``.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmonitor.llm.common import (
    arrow_schema, one_task_each, open_folder, read_table, rows_of_all, small_batches, text_or_empty, tokenizer_path,
)
from docmonitor.llm.tokens import batches, encoder
from docmonitor.session import materialise, scratch_path

MAGIC = b"TOKDAC01"
BLOCK = 512
FILE_TOKENS = 1 << 23
READ_TOKENS = 1 << 20

MANIFEST = arrow_schema({
    "part": pa.int32(), "seq": pa.int32(), "path": pa.string(), "part_start": pa.int64(),
    "n_docs": pa.int64(), "n_tokens": pa.int64(),
})
MANIFEST_DDL = "part int, seq int, path string, part_start long, n_docs long, n_tokens long"


def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each level: chunks, packed continuation bitmap, set bits before each block."""
    levels, rest = [], ids.astype("<u4", copy=False)
    while len(rest) or not levels:
        more = rest > 0xFF
        padded = np.zeros(-(-len(rest) // BLOCK) * BLOCK, bool)
        padded[: len(rest)] = more
        before = np.zeros(len(padded) // BLOCK + 1, "<u4")
        np.cumsum(padded.reshape(-1, BLOCK).sum(axis=1), out=before[1:])
        levels.append(((rest & 0xFF).astype(np.uint8), np.packbits(padded, bitorder="little"), before))
        rest = rest[more] >> 8
    return levels


def write_file(out, docs: list[tuple[int | None, int]], ids: np.ndarray) -> None:
    """``docs``: each document's number and first token here."""
    places, at = [], len(MAGIC)
    out.write(MAGIC)

    def put(data: bytes) -> None:
        nonlocal at
        places.append(at)
        out.write(data)
        at += len(data)

    levels = encode_levels(ids)
    for chunks, bits, before in levels:
        for part in (chunks, bits, before):
            put(part.tobytes())
    put(np.array([d or 0 for d, _ in docs], "<i8").tobytes())
    put(np.array([d is None for d, _ in docs], "u1").tobytes())
    put(np.array([s for _, s in docs] + [len(ids)], "<u8").tobytes())
    footer = np.array([len(docs), len(ids), len(levels), *places], "<u8").tobytes()
    out.write(footer + len(footer).to_bytes(8, "little") + MAGIC)


class DacFile:
    """Random access to the ids of one file, with small reads."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        tail = file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError("not a token file, or cut off")
        length = int.from_bytes(tail[:8], "little")
        head = np.frombuffer(file.read_at(length, size - 16 - length), "<u8").astype(int).tolist()
        self.n_docs, self.n_tokens, n_levels = head[:3]
        self.levels = [head[3 + 3 * k: 6 + 3 * k] for k in range(n_levels)]
        self.docs_at = head[3 + 3 * n_levels:]

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        ids = np.frombuffer(self.file.read_at(8 * self.n_docs, self.docs_at[0]), "<i8").tolist()
        nulls = self.file.read_at(self.n_docs, self.docs_at[1])
        starts = np.frombuffer(self.file.read_at(8 * self.n_docs + 8, self.docs_at[2]), "<u8").astype(np.int64)
        return [None if n else i for i, n in zip(ids, nulls)], starts

    def _bits(self, level: int, first: int, last: int) -> np.ndarray:
        """Bits ``first`` to ``last`` of a bitmap."""
        data = self.file.read_at(-(-last // 8) - first // 8, self.levels[level][1] + first // 8)
        return np.unpackbits(np.frombuffer(data, "u1"), bitorder="little")[first % 8: first % 8 + last - first]

    def _rank(self, level: int, at: int) -> int:
        """Set bits before ``at``."""
        block = at // BLOCK
        before = int.from_bytes(self.file.read_at(4, self.levels[level][2] + 4 * block), "little")
        return before + (int(self._bits(level, block * BLOCK, at).sum()) if at % BLOCK else 0)

    def tokens(self, first: int, last: int) -> np.ndarray:
        """The ids of tokens ``first`` to ``last`` (not included)."""
        if not 0 <= first <= last <= self.n_tokens:
            raise IndexError((first, last))
        out, at, shift = np.zeros(last - first, "<u4"), np.arange(last - first), 0
        for level in range(len(self.levels)):
            if first == last:
                break
            chunks = np.frombuffer(self.file.read_at(last - first, self.levels[level][0] + first), "u1")
            out[at] |= chunks.astype("<u4") << np.uint32(shift)
            bits = self._bits(level, first, last).astype(bool)
            first = self._rank(level, first)
            last, at, shift = first + int(bits.sum()), at[bits], shift + 8
        return out

    def token(self, i: int) -> int:
        return int(self.tokens(i, i + 1)[0])


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int,
                 file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encode all texts in ascending ``doc_id`` order into files under ``folder``.

    Null numbers come first, equal ones in order of their texts; a null text is empty;
    other columns are left out.  One range shuffle brings the order, its partitions hold
    whole runs of it, and a task cuts a new file after ``file_tokens`` ids (a document is
    never cut).  An empty table gives an empty manifest.  A file's name is new in each attempt, and only those of the attempts
    that count are in the manifest, which is written as a table: a lost executor costs a
    repeated task and an unused file.
    """
    encode = f"{folder}/ids"

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(encode)
        fs.create_dir(base, recursive=True)
        code, end = encoder(tokenizer), int(end_id).to_bytes(4, "little")
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        held, held_docs, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, start, held, held_docs, size
            name = f"{part:06d}-{seq:05d}-{uuid.uuid4().hex}.dac"
            path = f"{encode}/{name}"  # with its scheme: readers open the same store
            with fs.open_output_stream(f"{base}/{name}") as out:
                write_file(out, held_docs, np.frombuffer(b"".join(held), "<u4"))
            row = {"part": part, "seq": seq, "path": path, "part_start": start, "n_docs": len(held_docs), "n_tokens": size}
            seq, start, held, held_docs, size = seq + 1, start + size, [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=MANIFEST)

        for batch in batches(rows_of_all(rows)):
            for (doc_id, _), ids in zip(batch, code.encode_many([text for _, text in batch])):
                held_docs.append((doc_id, size))
                held += [ids, end]
                size += len(ids) // 4 + 1
                if size >= file_tokens:
                    yield flush()
        if held_docs:
            yield flush()

    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    ordered = texts.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return materialise(ordered.mapInArrow(write, MANIFEST_DDL), "token-files")


def with_starts(manifest: DataFrame) -> DataFrame:
    """Adds ``file_start``: the ids in all files before.  Only the sums of the parts, one
    row a task of the writer, are added up in one place."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("_before"))
    return manifest.join(parts, "part").withColumn("file_start", F.col("_before") + F.col("part_start")).drop("_before")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Per document of the files: number, start, number of tokens and checksum of its ids."""

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, base in rows_of_all(rows):
            fs, at = open_folder(path)
            with fs.open_input_file(at) as source:
                file = DacFile(source)
                numbers, starts = file.documents()
                i = 0
                while i < file.n_docs:
                    j = max(i + 1, int(np.searchsorted(starts, starts[i] + READ_TOKENS, "right")) - 1)
                    ids, first = file.tokens(int(starts[i]), int(starts[j])).tobytes(), int(starts[i])
                    cuts = [(int(s) - first) * 4 for s in starts[i:j + 1]]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(numbers[i:j], pa.int64()),
                        "start": pa.array(starts[i:j] + base),
                        "n_tokens": pa.array(np.diff(starts[i:j + 1])),
                        "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                    })
                    i = j

    files = one_task_each(with_starts(manifest).select("path", "file_start"))
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes ``documents`` into files, reads them back and returns a digest of each document."""
    small_batches(spark)
    manifest = write_tokens(read_table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"),
                            tokenizer_path("word_bpe_49k.json"), end_id=2)
    return read_tokens(manifest)
