"""Phrase collocations by set-oriented mining (SETM) over sorted occurrence relations.

The occurrence relation is written once, in chunks: the words of a chunk's texts as numbers,
sorted by piece and position, with a gap between pieces.  A round joins the relation of
frequent groups of k words with itself: two occurrences of one piece whose positions follow
each other are one occurrence of k + 1 words, found by one merge over the sorted positions.
Groups are counted in each chunk, the chunks' counts are summed in a shuffle, and what is
frequent goes back to its chunks, by which the next round semi-joins the relation before it
extends it.

Frequent groups of a length are numbered without large gaps, and a group of k + 1 words is the
pair of the numbers of its first and last k words.  So a chunk's groups are a sorted list of
short numbers, which is sent as steps from one to the next, a block for each bucket of groups.
A bucket sums its blocks and answers each with the numbers of what is frequent in it.  The answer
to the first block with a frequent group holds its key and count, too, and makes a row of it.

A word is known across chunks by 128 bits of hash of its language and itself, in rows a frequent
one by as few of them as tell the frequent words apart; a seed under which two frequent words
share 64 is not used, so groups of numbers are groups of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmonitor.llm.common import read_table, rows_of_all, small_batches, text_or_empty
from docmonitor.session import materialise

LONGEST = 3
LEAST = 10
PART = 50  # percent of a phrase's occurrences within a longer one that make it a part of that
PER_LANGUAGE = 2000
CHUNK_WORDS = 4_000_000
SUMMED_GROUPS = 1 << 22
SLICE_BYTES = 1 << 20
BROADCAST_ANSWERS = 1 << 26  # bytes; beyond, the chunks are shuffled
MOST_BITS = 32  # of a frequent group's number, as two are a group of one more word
BROADCAST_WORDS = 1 << 19  # of 16 bytes; beyond, the chunks' words are shuffled
NO_LANGUAGE = "und"
GAP = b"."
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + GAP * 9 + b" ")


class Numbers(dict):
    """Numbers of a chunk's words, given as they come; 0 is the gap."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Chunk:
    """Occurrences of some whole pieces of one language, in order."""

    def __init__(self):
        self.numbers, self.codes = Numbers({GAP: 0}), []

    def add(self, words: bytes) -> int:
        """A slice of a folded text, which ends where a piece ends; its size."""
        found = words.replace(GAP, b" . ").split()
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))
        self.codes.append(np.zeros(1, np.int32))
        return len(found) + 1

    def row(self, number: int, lang: str) -> pa.RecordBatch:
        codes = np.concatenate(self.codes)
        counts = np.bincount(codes, minlength=len(self.numbers)).astype(np.int32)
        planes = codes.view(np.uint8).reshape(-1, 4).T  # the high bytes together, as most are zero
        return pa.RecordBatch.from_arrays([
            pa.array([number]), pa.array([lang]), pa.array([planes.tobytes()]), pa.array([b" ".join(self.numbers)]),
            pa.array([counts.tobytes()]), pa.array([int(counts[1:].sum())], pa.int64())], names=list(CHUNK))


CHUNK = {"chunk": "long", "lang": "string", "codes": "binary", "words": "binary", "counts": "binary", "n": "long"}


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of chunks; only one is held outside Arrow's memory."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(column[i].as_py() for column in batch.columns)


def _codes(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view(np.int32).ravel()


def word_numbers(lang: str, words: bytes, seed: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a chunk's words everywhere (of the gap, too), and 64 more bits of hash."""
    own = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"), seed)
    raw = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w, own) for w in words.split(b" ")]), np.uint64).reshape(-1, 2)
    return (raw[:, 0] & np.uint64((1 << bits) - 1)).view(np.int64), raw[:, 1].copy().view(np.int64)


def slices(text: bytes) -> Iterator[bytes]:
    """A folded text in parts of some ``SLICE_BYTES``, cut at gaps only."""
    at = 0
    while at < len(text):
        end = text.find(GAP, at + SLICE_BYTES)
        end = len(text) if end < 0 else end + 1
        yield text[at:end]
        at = end


def occurrences(docs: DataFrame, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """The written relation of all texts, in chunks of a language (``CHUNK``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, chunks, size = TaskContext.get().partitionId() << 32, {}, 0
        for lang, text in rows_of_all(batches):
            for part in slices(text.translate(FOLD)):
                if lang not in chunks:
                    chunks[lang] = Chunk()
                size += chunks[lang].add(part)
                if size >= chunk_words:
                    for own in sorted(chunks):
                        yield chunks[own].row(number, own)
                        number += 1
                    chunks, size = {}, 0
        for own in sorted(chunks):
            yield chunks[own].row(number, own)
            number += 1

    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                        text_or_empty().cast("binary").alias("text"))
    return materialise(texts.mapInArrow(run, _ddl(CHUNK)), "occurrences", compression="zstd")


def _packed(values: np.ndarray) -> bytes:
    """Numbers with their high bytes together, as most are zero."""
    return pa.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data, n * size, "zstd", asbytes=True), np.uint8).reshape(size, n).T.copy().view(kind).ravel()


def _dealt(keys: np.ndarray, more: np.ndarray, buckets: int) -> tuple[np.ndarray, list[int]]:
    """The order of a chunk's groups by bucket, key and 64 more bits, and where each bucket ends in it, from 0."""
    mixed = keys * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed >>= np.uint64(32)
    bucket = (mixed % np.uint64(buckets)).astype(np.min_scalar_type(buckets))
    ends = np.cumsum(np.bincount(bucket, minlength=buckets))
    return np.lexsort((more, keys, bucket)), [0, *ends.tolist()]


def _blocks(chunk: int, keys: np.ndarray, more: np.ndarray, counts: np.ndarray, ends: list[int]) -> Iterator[pa.RecordBatch]:
    """A chunk's dealt groups, a row a bucket (``BLOCK``); groups of several words have no ``more``."""
    own = [(b, x, y) for b, (x, y) in enumerate(zip(ends, ends[1:])) if y > x]
    for at in range(0, len(own), 256):
        part = own[at:at + 256]
        yield pa.RecordBatch.from_arrays([
            pa.array([b for b, _, _ in part], pa.int64()), pa.array([chunk] * len(part), pa.int64()),
            pa.array([y - x for _, x, y in part], pa.int64()),
            pa.array([_packed(np.diff(keys[x:y], prepend=np.uint64(0))) for _, x, y in part], pa.binary()),
            pa.array([_packed(more[x:y]) if len(more) else None for _, x, y in part], pa.binary()),
            pa.array([_packed(counts[x:y].astype(np.uint32)) for _, x, y in part], pa.binary())], names=list(BLOCK))


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{c} {t}" for c, t in columns.items())


BLOCK = {"bucket": "long", "chunk": "long", "size": "long", "keys": "binary", "more": "binary", "counts": "binary"}
ANSWER = {"bucket": "long", "chunk": "long", "size": "long", "flags": "binary", "numbers": "binary",
          "firsts": "long", "own": "binary", "keys": "binary", "more": "binary", "counts": "binary", "found": "long"}


def _answers(blocks: DataFrame, least: int, buckets: int, name: str) -> DataFrame:
    """What of each block is frequent (``ANSWER``): ``flags`` of its groups and ``numbers`` of the flagged in their bucket.

    Of the ``firsts`` of them, which are in no chunk before, it has the numbers (``own``), ``keys``, ``more`` and
    ``counts`` over all chunks.  ``found`` is what is frequent in the bucket.
    """

    def meet(blocks: pa.Table) -> pa.Table:
        blocks = blocks.sort_by("chunk")
        sizes = blocks["size"].to_pylist()
        keys = np.concatenate([np.cumsum(_unpacked(b, np.uint64, n), dtype=np.uint64) for b, n in zip(blocks["keys"].to_pylist(), sizes)])
        counts = np.concatenate([_unpacked(b, np.uint32, n) for b, n in zip(blocks["counts"].to_pylist(), sizes)])
        if blocks["more"].null_count:
            more = keys[:0]
            order = np.argsort(keys, kind="stable")  # a group's first chunk first
            new = np.diff(keys[order], prepend=~keys[order[:1]]) != 0
        else:
            more = np.concatenate([_unpacked(b, np.uint64, n) for b, n in zip(blocks["more"].to_pylist(), sizes)])
            order = np.lexsort((more, keys))
            new = (np.diff(keys[order], prepend=~keys[order[:1]]) != 0) | (np.diff(more[order], prepend=np.uint64(0)) != 0)
        at = np.flatnonzero(new)
        sums = np.add.reduceat(counts[order], at, dtype=np.int64)
        frequent = sums >= least
        numbers, firsts = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int64)
        numbers[order] = np.where(frequent, np.cumsum(frequent), 0).astype(np.uint32)[np.cumsum(new) - 1]
        firsts[order[at[frequent]]] = sums[frequent]
        kept, first, ends = numbers > 0, firsts > 0, np.cumsum(sizes)
        parts = [(slice(end - n, end), kept[end - n:end], first[end - n:end]) for n, end in zip(sizes, ends.tolist())]
        steps = lambda x, mask: _packed(np.diff(x[mask], prepend=x.dtype.type(0)))
        return pa.table([blocks["bucket"], blocks["chunk"], blocks["size"],
                         pa.array([np.packbits(k).tobytes() for _, k, _ in parts], pa.binary()),
                         pa.array([steps(numbers[at], k) for at, k, _ in parts], pa.binary()),
                         pa.array([int(np.count_nonzero(f)) for _, _, f in parts], pa.int64()),
                         pa.array([steps(numbers[at], f) for at, _, f in parts], pa.binary()),
                         pa.array([steps(keys[at], f) for at, _, f in parts], pa.binary()),
                         pa.array([_packed(more[at][f]) if len(more) else None for at, _, f in parts], pa.binary()),
                         pa.array([_packed(firsts[at][f]) for at, _, f in parts], pa.binary()),
                         pa.array(np.full(len(sizes), frequent.sum()))], names=list(ANSWER))

    answers = materialise(blocks.groupBy("bucket").applyInArrow(meet, _ddl(ANSWER)), name)
    most = answers.agg(F.max((F.col("found") - 1) * buckets + F.col("bucket"))).first()[0] or 0
    if most >> MOST_BITS:
        raise ValueError(f"a frequent group would have number {most}, more than {MOST_BITS} bits")
    return answers


def _everywhere(numbers: bytes, n: int, bucket: int, buckets: int) -> np.ndarray:
    """A bucket's numbers, which count from 1, as numbers that are valid everywhere."""
    return (np.cumsum(_unpacked(numbers, np.uint32, n), dtype=np.int64) - 1) * buckets + bucket


def _numbers(answers: list, level: int, buckets: int) -> np.ndarray:
    """Everywhere valid numbers of a chunk's groups of ``level`` words, as dealt; -1: not frequent."""
    parts = [np.zeros(0, np.int64)]
    for answer in sorted((a for a in answers if a["level"] == level), key=lambda a: a["bucket"]):
        kept = np.unpackbits(np.frombuffer(answer["flags"], np.uint8), count=answer["size"]).view(bool)
        parts.append(np.full(len(kept), -1, np.int64))
        parts[-1][kept] = _everywhere(answer["numbers"], np.count_nonzero(kept), answer["bucket"], buckets)
    return np.concatenate(parts)


def _found(answers: DataFrame, buckets: int) -> DataFrame:
    """``chunk, number, key, more, n``: each frequent group once, with its first chunk and its count in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, bucket, size, own, keys, more, counts in rows_of_all(batches):
            keys = np.cumsum(_unpacked(keys, np.uint64, size), dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(size, chunk)), pa.array(_everywhere(own, size, bucket, buckets)), pa.array(keys),
                pa.nulls(size, pa.int64()) if more is None else pa.array(_unpacked(more, np.int64, size)),
                pa.array(_unpacked(counts, np.int64, size))], names=["chunk", "number", "key", "more", "n"])

    return answers.where("firsts > 0").select("chunk", "bucket", "firsts", "own", "keys", "more", "counts").mapInArrow(
        run, "chunk long, number long, key long, more long, n long")


def _beside(chunks: DataFrame, answers: dict[int, DataFrame]) -> DataFrame:
    """The chunks beside the numbers in the answers to their blocks."""
    rows = reduce(DataFrame.unionByName, [a.select("chunk", F.struct(
        F.lit(level).alias("level"), "bucket", "size", "flags", "numbers").alias("answer")) for level, a in answers.items()])
    size = rows.agg(F.sum(F.octet_length("answer.flags") + F.octet_length("answer.numbers") + 48)).first()[0] or 0
    own = rows.groupBy("chunk").agg(F.collect_list("answer").alias("answers"))  # of one chunk: bounded
    return chunks.join(F.broadcast(own) if size <= BROADCAST_ANSWERS else own, "chunk").select("chunk", "lang", "codes", "words", "answers")


def _hashes(lang: str, words: bytes, seed: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a chunk's words, without the gap, and the bits they are dealt by."""
    ids, more = word_numbers(lang, words, seed, bits)
    return ids[1:].view(np.uint64), more[1:].view(np.uint64)


def _sum_words(chunks: DataFrame, seed: int, bits: int, least: int, buckets: int) -> DataFrame:
    """Answers to all chunks' words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, lang, words, counts in _one_by_one(batches):
            ids, more = _hashes(lang, words, seed, bits)
            order, ends = _dealt(more, ids, buckets)
            yield from _blocks(chunk, more[order], ids[order], np.frombuffer(counts, np.int32)[1:][order], ends)

    return _answers(chunks.select("chunk", "lang", "words", "counts").mapInArrow(run, _ddl(BLOCK)), least, buckets, "sums-1")


def _chunk_groups(codes: np.ndarray, ids: np.ndarray, more: np.ndarray, answers: list, level: int,
                  buckets: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Keys and counts of a chunk's groups of ``level`` words, as dealt, and the buckets' ends.

    ``starts`` and ``numbers`` are the relation of k words: sorted positions, and the frequent
    group that starts there.
    """
    of_words = np.full(len(ids) + 1, -1, np.int64)  # the gap is 0
    of_words[1 + _dealt(more, ids, buckets)[0]] = _numbers(answers, 1, buckets)
    numbers = of_words[codes]
    starts = np.flatnonzero(numbers >= 0).astype(np.int32)
    numbers = numbers[starts]
    for k in range(2, level + 1):
        adjacent = starts[1:] == starts[:-1] + 1
        keys = numbers[:-1][adjacent].view(np.uint64) << np.uint64(MOST_BITS)
        keys |= numbers[1:][adjacent].view(np.uint64)
        starts = starts[:-1][adjacent]
        order = np.argsort(keys)
        keys = keys[order]
        new = np.ones(len(keys), bool)
        np.not_equal(keys[1:], keys[:-1], out=new[1:])
        at = np.flatnonzero(new)
        keys = keys[at]
        dealt, ends = _dealt(keys, np.zeros(len(keys), np.uint64), buckets)
        if k < level:
            found, numbers = np.empty(len(keys), np.int64), np.empty(len(starts), np.int64)
            found[dealt] = _numbers(answers, k, buckets)
            numbers[order] = found[np.cumsum(new) - 1]
            kept = numbers >= 0
            starts, numbers = starts[kept], numbers[kept]
    return keys[dealt], np.diff(at, append=len(order))[dealt], ends


def _sum_groups(chunks: DataFrame, answers: dict[int, DataFrame], level: int, seed: int, bits: int, least: int, buckets: int) -> DataFrame:
    """Answers to all chunks' groups of ``level`` words, after those to shorter ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, lang, planes, words, own in _one_by_one(batches):
            keys, counts, ends = _chunk_groups(_codes(planes), *_hashes(lang, words, seed, bits), own, level, buckets)
            yield from _blocks(chunk, keys, keys[:0], counts, ends)

    return _answers(_beside(chunks, answers).mapInArrow(run, _ddl(BLOCK)), least, buckets, f"sums-{level}")


def _count_groups(answers: DataFrame, shorter: DataFrame, level: int, buckets: int) -> DataFrame:
    """``chunk, number, w1.., n``: each frequent group of ``level`` words once, from the groups with a word less."""
    found = _found(answers, buckets).select("chunk", "number", F.shiftrightunsigned("key", MOST_BITS).alias("first"),
                                            F.col("key").bitwiseAND(F.lit((1 << MOST_BITS) - 1)).alias("last"), "n")
    left = shorter.select(F.col("number").alias("first"), *_words(1, level))
    right = shorter.select(F.col("number").alias("last"), F.col(f"w{level - 1}").alias(f"w{level}"))
    return found.join(left, "first").join(right, "last").select("chunk", "number", *_words(1, level + 1), "n")


def _words(i: int, j: int) -> list[str]:
    return [f"w{k}" for k in range(i, j)]


def _low(bits: int) -> Column:
    """The lowest bits of a frequent word's number."""
    return F.col("w1").bitwiseAND(F.lit((1 << bits) - 1 if bits < 64 else -1).cast("long")).alias("w1")


def enough_bits(named: DataFrame, bits: int) -> int:
    """How many low bits of ``w1`` tell all words apart, not much more than needed; 0 if ``bits`` don't."""
    few = min(bits, 2 * named.count().bit_length() + 4)  # of random numbers two agree once in 32 times
    while not named.select(_low(few)).groupBy("w1").count().where("count > 1").isEmpty():
        if few == bits:
            return 0
        few = min(bits, few + 6)
    return few


def frequent_groups(chunks: DataFrame, longest: int = LONGEST, least: int = LEAST,
                    bits: int = 64) -> tuple[dict[int, DataFrame], int, int]:
    """Frequent groups of each length (``w1.., a, number, chunk``: one they are in), and the seed and bits of the words' numbers.

    A word pair of a third of all texts reaches the shuffle once a chunk.  Words are
    counted by 128 bits of hash; in rows as few of the first ``bits`` (fewer in tests) as
    no two of them share stand for the frequent ones, as random bits don't compress in a shuffle.
    """
    buckets = 1 + (chunks.agg(F.sum("n")).first()[0] or 0) // SUMMED_GROUPS
    seed = few = 0
    while not few:
        answers = {1: _sum_words(chunks, seed, bits, least, buckets)}
        named = materialise(_found(answers[1], buckets).select(
            F.col("more").alias("w1"), F.col("key").alias("more"), F.col("n").alias("a"), "chunk", "number"), "words")
        few = enough_bits(named, bits)
        seed += not few
    groups = {1: named.select(_low(few), "more", "a", "chunk", "number")}
    for level in range(2, longest + 1):
        answers[level] = _sum_groups(chunks, answers, level, seed, bits, least, buckets)
        counted = _count_groups(answers[level], groups[level - 1], level, buckets)
        groups[level] = materialise(counted.withColumnRenamed("n", "a"), f"groups-{level}")
    return groups, seed, few


def _names(chunks: DataFrame, wanted: DataFrame, seed: int, bits: int) -> DataFrame:
    """``w1, word`` of wanted frequent words; the other 64 bits tell a rare word with the same number from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in rows_of_all(batches):
            ids, more = word_numbers(lang, words, seed, bits)
            yield pa.RecordBatch.from_arrays([pa.array(ids[1:]), pa.array(more[1:]), pa.array(words.split(b" ")[1:], pa.binary())],
                                             names=["w1", "more", "word"])

    known = chunks.select("lang", "words").mapInArrow(run, "w1 long, more long, word binary")
    if wanted.count() <= BROADCAST_WORDS:
        wanted = F.broadcast(wanted)
    return materialise(known.join(wanted, ["w1", "more"], "left_semi").groupBy("w1").agg(
        F.first("word").cast("string").alias("word")), "names")


def _scored(groups: dict[int, DataFrame], m: int) -> DataFrame:
    """Candidates of ``m`` words with ``a``, a chunk, and the cut with the lowest score (``score, k, l, r``)."""
    rows = groups[m]
    for k in range(1, m):
        left = groups[k].select(*_words(1, k + 1), F.col("a").alias(f"l{k}"))
        right = groups[m - k].select(*(F.col(f"w{i}").alias(f"w{i + k}") for i in range(1, m - k + 1)), F.col("a").alias(f"r{k}"))
        rows = rows.join(left, _words(1, k + 1)).join(right, _words(k + 1, m + 1))
    exact = "CAST(1000000 AS DECIMAL(38, 0)) * a * a DIV (CAST(l{k} AS DECIMAL(38, 0)) * r{k})"
    cuts = [F.struct(F.expr(exact.format(k=k)).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
            for k in range(1, m)]
    cut = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return rows.select(*_words(1, m + 1), "a", "chunk", cut.alias("cut"))


def _without_parts(rows: DataFrame, groups: dict[int, DataFrame], m: int, part: int) -> DataFrame:
    """Without the candidates that stand mostly within a longer one, dropped or not."""
    inside = [groups[longer].select(*(F.col(f"w{i + at}").alias(f"w{i}") for i in range(1, m + 1)), F.col("a").alias("longer"))
              for longer in groups if longer > m for at in range(longer - m + 1)]
    if not inside:
        return rows
    most = reduce(DataFrame.unionByName, inside).groupBy(*_words(1, m + 1)).agg(F.max("longer").alias("longer"))
    joined = rows.join(most, _words(1, m + 1), "left")
    return joined.where(F.col("longer").isNull() | (100 * F.col("longer") < part * F.col("a"))).drop("longer")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, part: int = PART,
                 per_language: int = PER_LANGUAGE, bits: int = 64, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases.

    A phrase of two to ``longest`` words that occurs ``a >= least`` times is a candidate; its
    score is a million times ``a * a / (l * r)``, floored, for the cut into two parts with the
    lowest score (of equal ones the first); candidates that stand mostly (``part`` percent)
    within a longer candidate leave.  Ties rank by ``a``, then by the phrase's bytes.  Null
    texts are empty, a null language is ``und``; texts without words and an empty table
    give nothing; repeated rows all count.  Other columns are not read.  A very long text is
    read in slices that end where a piece ends; one piece is held whole.
    """
    chunks = occurrences(docs, chunk_words)
    totals = chunks.groupBy("lang").agg(F.sum("n").alias("n"))
    groups, seed, bits = frequent_groups(chunks, longest, least, bits)
    words = _words(1, longest + 1)
    scored = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), [
        _without_parts(_scored(groups, m), groups, m, part) for m in range(2, longest + 1)])
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = scored.join(chunks.select("chunk", "lang"), "chunk").select("lang", *words, "a", "cut.*").withColumn(
        "rank", F.rank().over(by_score)).where(F.col("rank") <= per_language)  # ties at the end stay for now
    near = materialise(near.drop("rank", "k"), "phrases")
    used = reduce(DataFrame.unionByName, [near.select(F.col(w).alias("w1")) for w in words])
    names = _names(chunks, materialise(groups[1].join(used, "w1", "left_semi").select("w1", "more"), "used"), seed, bits)
    for w in words:
        near = near.join(names.select(F.col("w1").alias(w), F.col("word").alias(f"word_{w}")), w, "left")
    near = near.withColumn("phrase", F.concat_ws(" ", *(f"word_{w}" for w in words)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language of ``documents``."""
    small_batches(spark)
    return collocations(read_table(spark, sf_dir, "documents"))


OP11_SQL = r"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
one AS (SELECT lang, x AS w1, count(*) AS a FROM (SELECT lang, unnest(w) AS x FROM words) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM one GROUP BY lang),
two AS (SELECT lang, w1, w2, count(*) AS a FROM (SELECT lang, w[i] AS w1, w[i + 1] AS w2 FROM
  (SELECT lang, w, unnest(range(1, len(w))) AS i FROM words)) GROUP BY ALL HAVING count(*) >= 10),
three AS (SELECT lang, w1, w2, w3, count(*) AS a FROM (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM
  (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) > 2)) GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.a, 1 AS k, x.a AS l, y.a AS r FROM two t
    JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one y ON y.lang = t.lang AND y.w1 = t.w2
    WHERE NOT EXISTS (SELECT 1 FROM three h WHERE h.lang = t.lang AND h.w1 = t.w1 AND h.w2 = t.w2 AND 100 * h.a >= 50 * t.a)
      AND NOT EXISTS (SELECT 1 FROM three h WHERE h.lang = t.lang AND h.w2 = t.w1 AND h.w3 = t.w2 AND 100 * h.a >= 50 * t.a)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 1, x.a, y.a FROM three t
    JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 2, x.a, y.a FROM three t
    JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.w1 = t.w3),
scored AS (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
JOIN totals USING (lang) WHERE rank <= 2000"""
