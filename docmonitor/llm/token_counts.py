"""Token counts per section of a document, from one encoding of the whole text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmonitor.llm.common import read_table, rows_of_all, small_batches, text_or_empty, tokenizer_path
from docmonitor.llm.tokens import batches, encoder


def lines(text: str) -> list[int]:
    """Starts of the lines; a line keeps its line end."""
    starts = [0]
    at = text.find("\n")
    while 0 <= at < len(text) - 1:
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return starts


def attribute(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them reach over one of its bounds.

    ``sections``: the sections' starts (the first is 0), which tile the text.  Both lists
    are sorted, so the interval join is two binary searches a token.  A token belongs to
    the section that holds most of its characters, of equal ones to the first; one
    without characters to the section in which it stands.
    """
    first = np.searchsorted(sections, starts, "right") - 1
    last = np.maximum(first, np.searchsorted(sections, ends - 1, "right") - 1)
    owner = first.copy()
    for i in np.flatnonzero(first != last).tolist():
        a, b = int(first[i]), int(last[i])
        cuts = [int(starts[i]), *sections[a + 1: b + 1].tolist(), int(ends[i])]
        owner[i] = a + int(np.argmax(np.diff(cuts)))
    crossing = np.bincount(owner[first != last], minlength=len(sections))
    return np.bincount(owner, minlength=len(sections)), crossing


def token_counts(docs: DataFrame, tokenizer: str, sections: Callable[[str], list[int]] = lines) -> DataFrame:
    """One row a section: ``doc_id, section, char_start, char_end, n_tokens, n_crossing, doc_tokens``.

    A document is encoded once, as a whole; its sections' counts add up to its count.  A
    null or empty text has one empty section with no token.  Repeated rows are counted
    each; other columns are left out.  No shuffle.
    """
    ints = pa.int64()

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        for batch in batches(rows_of_all(rows)):
            out: list[list[np.ndarray]] = []
            ids: list = []
            for (doc_id, text), (starts, ends) in zip(batch, code.spans_many([text for _, text in batch])):
                bounds = np.array(sections(text), np.int64)
                n, crossing = attribute(starts, ends, bounds)
                out.append([np.arange(len(bounds)), bounds, np.append(bounds[1:], len(text)), n, crossing,
                            np.full(len(bounds), len(starts))])
                ids += [doc_id] * len(bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, ints), *(pa.array(np.concatenate(c), ints) for c in zip(*out))],
                names=["doc_id", "section", "char_start", "char_end", "n_tokens", "n_crossing", "doc_tokens"])

    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return texts.mapInArrow(count, "doc_id long, section long, char_start long, char_end long, "
                                   "n_tokens long, n_crossing long, doc_tokens long")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every line of every document."""
    small_batches(spark)
    return token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
