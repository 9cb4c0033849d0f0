"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in turn over the features.  A tree on one feature's bins, or on
the cells of two features, only adds to that feature's or pair's lookup table, so the model
is a sum of table entries, and a text is scored by adding up one entry a table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmonitor.llm.common import read_table, rows_of_all, small_batches, text_or_empty

SAMPLE_ROWS = 20_000
BINS = 48
PAIR_BINS = 8
PAIRS = 10
ROUNDS = 150
RATE = 0.1
PREDICT_AT = 0.7

FEATURES = (
    "log_words", "chars_per_word", "upper_share", "digit_share", "symbol_share", "mark_share", "marked_words",
    "unlike_words", "top_word_share", "repeat_share", "dup_line_share", "line_words", "stop_share", "long_words",
    "space_share", "short_words",
)


def features(text: str) -> list[float]:
    """Numbers of a whole text; all are finite, also for an empty one."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    n, size = len(words), max(1, len(data))
    if not words:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    upper = size - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = size - len(data.translate(None, b"0123456789"))
    symbols = size - len(data.translate(None, b"#*$%&|<>"))
    marks = size - len(data.translate(None, b"!?=_{}[]()/\\@^~+;:\"'-"))
    marked = sum(k for w, k in counts.items() if not w[-1:].isalnum() and w[-1] < 128 and w[-1] not in b".,")
    lines = [x for x in data.split(b"\n") if x.strip()]
    windows = n - 4
    repeats = windows - len(set(zip(words, words[1:], words[2:], words[3:], words[4:]))) if windows > 0 else 0
    return [
        float(np.log1p(n)), sum(map(len, words)) / n, upper / size, digits / size, symbols / size, marks / size, marked / n,
        len(counts) / n, max(counts.values()) / n, repeats / max(1, windows), 1 - len(set(lines)) / max(1, len(lines)),
        min(1000.0, n / max(1, len(lines))), data.count(b".") / n,
        sum(k for w, k in counts.items() if len(w) > 14) / n, 1 - sum(map(len, words)) / size,
        sum(k for w, k in counts.items() if len(w) <= 3) / n,
    ]


def cut_points(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def shallow_tree(grad: np.ndarray, hess: np.ndarray, splits: int = 3, ridge: float = 2.0) -> np.ndarray:
    """Values of a tree of a few splits over ordered bins, by their gradient sums."""
    values, parts = np.zeros(len(grad)), [(0, len(grad))]
    gain = lambda g, h: g * g / (h + ridge)
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    for _ in range(splits):
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a < 2:
                continue
            at = np.arange(a + 1, b)
            won = gain(g[at] - g[a], h[at] - h[a]) + gain(g[b] - g[at], h[b] - h[at]) - gain(g[b] - g[a], h[b] - h[a])
            k = int(np.argmax(won))
            if won[k] > best[0]:
                best = (won[k], (a, b), int(at[k]))
        if best[1] is None:
            break
        a, b = best[1]
        parts.remove((a, b))
        parts += [(a, best[2]), (best[2], b)]
    for a, b in parts:
        values[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return values


def pair_tree(grad: np.ndarray, hess: np.ndarray, ridge: float = 2.0) -> np.ndarray:
    """A tree over two features' cells: the best cut of the one, then of the other on each side."""
    best = (-1.0, None)
    for g, h, turn in ((grad, hess, False), (grad.T, hess.T, True)):
        for cut in range(1, g.shape[0]):
            values, won = np.zeros(g.shape), 0.0
            for part in (slice(0, cut), slice(cut, None)):
                row = shallow_tree(g[part].sum(axis=0), h[part].sum(axis=0), 1, ridge)
                values[part] = row
                won += float((row * g[part].sum(axis=0)).sum())
            if won > best[0]:
                best = (won, values.T if turn else values)
    return best[1] if best[1] is not None else np.zeros(grad.shape)


class Model:
    """Lookup tables of single features and of pairs."""

    def __init__(self, base: float, cuts, tables, pair_cuts, pairs):
        self.base, self.cuts, self.tables, self.pair_cuts, self.pairs = base, cuts, tables, pair_cuts, pairs

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, x[:, j], "right")]
        if self.pairs:
            cells = [np.searchsorted(cuts, x[:, j], "right") for j, cuts in enumerate(self.pair_cuts)]
            for (i, j), table in self.pairs.items():
                total += table[cells[i], cells[j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS) -> Model:
    """Boosts the features in turn, then the pairs that promise most.  Without rows, or with
    one class only, every text gets the share of ones (a half without rows)."""
    if not len(y):
        return Model(0.0, [], [], [], {})
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    cuts = [cut_points(x[:, j], BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    margin = np.full(len(y), base)
    if y.min() == y.max():
        return Model(base, cuts, tables, [], {})

    def sums(cell, size):
        p = 1 / (1 + np.exp(-margin))
        return np.bincount(cell, y - p, size), np.bincount(cell, p * (1 - p), size)

    for _ in range(rounds):
        for j, table in enumerate(tables):
            step = RATE * shallow_tree(*sums(bins[j], len(table)))
            table += step
            margin += step[bins[j]]
    pair_cuts = [cut_points(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    coarse = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(pair_cuts)]
    width = [len(c) + 1 for c in pair_cuts]
    cell = {(i, j): coarse[i] * width[j] + coarse[j] for i, j in combinations(range(x.shape[1]), 2)}
    promise = {}
    for i, j in cell:
        g, h = sums(cell[i, j], width[i] * width[j])
        promise[i, j] = float((g * g / (h + 2)).sum())
    chosen = sorted(cell, key=lambda k: -promise[k])[:pairs]
    lookup = {(i, j): np.zeros((width[i], width[j])) for i, j in chosen}
    for _ in range(rounds // 3):
        for (i, j), table in lookup.items():
            g, h = (s.reshape(table.shape) for s in sums(cell[i, j], table.size))
            step = RATE * pair_tree(g, h)
            table += step
            margin += step.ravel()[cell[i, j]]
    return Model(base, cuts, tables, pair_cuts, lookup)


def held_out(doc_id):
    return (F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2)


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``sample_rows`` labelled documents, the same ones in
    every run: those with the least hash.  Rows without label or number, and those held
    out, are never among them; of contradicting labels of a document the mean decides.
    The sample bounds what is broadcast, and what comes to the driver (some 100 bytes a row).
    """
    sample = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(sample), "doc_id").select("y", "text")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[y, *features(text)] for y, text in rows_of_all(iter([batch]))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], names=["row"])

    rows = texts.mapInArrow(compute, "row array<double>").toArrow().column("row").to_pylist()
    table = np.array(sorted(rows)).reshape(-1, len(FEATURES) + 1)
    return table[:, 1:], table[:, 0]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Adds nothing to a document but ``held_out``, ``score`` and ``predicted`` beside its number.

    A null text scores as an empty one; a null number is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some tables of 48 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            x = np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))
            s = shared.value.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= PREDICT_AT).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                       text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fits on a sample of labelled documents that aren't held out, scores every document."""
    small_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, fit(*training_rows(docs, read_table(spark, sf_dir, "labels"))))
