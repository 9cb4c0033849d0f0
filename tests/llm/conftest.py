import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from samples import prose  # noqa: E402


@pytest.fixture(scope="session")
def shared(spark):
    """The tests' session, with small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    return spark


DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size long, copies long"


@pytest.fixture(scope="session")
def documents(shared):
    """Documents from ``(doc_id, text, lang, source)`` rows, with columns whose names clash."""

    def make(rows):
        full = [(i, t, lang, s, None if t is None else len(t), None, 7, None) for i, t, lang, s in rows]
        return shared.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def mixed_rows():
    """Nulls, empty and long texts, ties, repeated rows and odd white space."""
    rows = [(i, prose(i, 20 + 13 * i % 300), ("en", "fr", None)[i % 3], f"s{i % 5}") for i in range(60)]
    rows += [(100, None, "en", "s0"), (101, "", None, None), (102, " \n\t ", "fr", "s1"), (None, prose(5, 40), "en", "s2"),
             (103, prose(6, 60_000), "en", "s3"), (104, "x" * 30_000, "en", "s4"), (107, prose(7, 31), "en", "s2"),
             (107, prose(7, 31), "en", "s2"), (105, "It's  a\x1ftest of 日本語 <|endoftext|> \U0001f44d\n\n b", None, "é")]
    return rows
