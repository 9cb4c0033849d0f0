"""Best-fit-decreasing packing of documents into sequences of a fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmonitor.llm.common import read_table, rows_of_all, small_batches, text_or_empty, tokenizer_path
from docmonitor.llm.tokens import batches, encoder
from docmonitor.session import materialise

MAX_TOKENS = 2048
GROUP_TOKENS = 1 << 24
GROUP_PIECES = 200_000
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, text_key long, place long"


class OpenBins:
    """Open bins by room left, under a segment tree over all possible rooms.

    A node counts the open bins whose room lies in its range.  ``tightest`` walks from
    the leaf of the wanted room up to the first right neighbour that has any, and down
    to its leftmost: the bin with the least sufficient room, in logarithmic time.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        at = room + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def put(self, bin_id: int, room: int) -> None:
        self.bins[room].append(bin_id)
        self._add(room, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Takes out the open bin with the least room of at least ``length``."""
        at = length + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at *= 2
                at += not self.count[at]
        room = at - self.leaves
        self._add(room, -1)
        return self.bins[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; the longest go first, equal ones in the given order."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms, new = OpenBins(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = rooms.tightest(length)
        if found is None:
            found, new = (new, capacity), new + 1
        bins[i], offsets[i] = found[0], capacity - found[1]
        if found[1] > length:
            rooms.put(found[0], found[1] - length)
    return bins, offsets


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Each document's ids with the end id, cut into pieces of at most ``max_tokens``.

    Only the first piece of a longer document may be shorter.  A null text is empty,
    so it yields the end id alone.  No shuffle.
    """

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end, place = encoder(tokenizer), int(end_id).to_bytes(4, "little"), 0
        for batch in batches(rows_of_all(rows)):
            out = []
            for (doc_id, key, _), ids in zip(batch, code.encode_many([text for *_, text in batch])):
                ids += end
                n = len(ids) // 4
                cuts = [0, *range((n - 1) % max_tokens + 1, n + 1, max_tokens)]
                out += [(doc_id, piece, a, b - a, zlib.crc32(ids[4 * a: 4 * b]), key, place)
                        for piece, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                place += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in
                 zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "text_key", "place"])

    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), text_or_empty().alias("text"))
    return texts.mapInArrow(cut, PIECES)


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, group_tokens: int = GROUP_TOKENS,
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``: best-fit decreasing within groups.

    Pieces are spread over groups by hash, so that a group has about ``group_tokens``
    tokens or ``group_pieces`` pieces, whatever the input's size, and every group sees
    the whole mix of lengths; ``place`` (of a row in its task) deals out rows repeated in full.  A group wastes about one sequence of some thousands over a
    packing of everything in one place.  Rows that are equal in all that is hashed stay
    packed apart, as each is a row of its own.  An empty table gives an empty result.
    """
    pieces = materialise(pieces, "pieces")
    tokens, rows = pieces.agg(F.sum("length"), F.count("*")).first()
    groups = max(1, -(-(tokens or 0) // group_tokens), -(-rows // group_pieces))

    def fill(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "text_key", "piece", "place"], ascending=[False, True, True, True, True], kind="stable")
        bins, offsets = best_fit_decreasing(pdf["length"].to_numpy(np.int64), max_tokens)
        # 2^31 sequences a group are more than its tokens allow
        pdf = pdf.assign(sequence_id=(int(key[0]) << 31) + bins, offset=offsets, length=pdf["length"].astype("int64"))
        return pdf[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    group = F.pmod(F.xxhash64("doc_id", "piece", "text_key", "place"), F.lit(groups)).alias("group")
    return pieces.select(group, "*").groupBy("group").applyInPandas(
        fill, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all ``documents`` into sequences of at most 2048 tokens."""
    small_batches(spark)
    return pack(token_pieces(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=0))
