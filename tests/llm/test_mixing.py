import re

import pytest
from pyspark.sql import functions as F

from samples import prose
from docmonitor.llm import mixing


def by_hand(sizes, weights, share=1.5, most=2):
    """Targets by sharing the excess again and again."""
    target, left, open_ = {}, share * sum(sizes.values()), set(sizes)
    while open_:
        total = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / total >= most * sizes[s]}
        if not full:
            return target | {s: left * weights[s] / total for s in open_}
        for s in full:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [[5], [10, 10, 10, 10], [1000, 1, 1, 500, 30, 30], [0, 7, 0, 9], [0, 0]])
def test_targets(shared, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    rows = shared.createDataFrame([(n, s) for n, s in zip(names, sizes)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(mixing.ranked_weights(rows)).collect()}
    want = by_hand(dict(zip(names, sizes)), {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)})
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes))


def test_mix(documents, mixed_rows):
    rows = [(1000 + i, prose(i, 5 + i * 7 % 90), "en", "hot" if i % 3 else f"s{i % 4}") for i in range(1500)] + mixed_rows
    docs = documents(rows)
    got = mixing.mix(mixing.size_documents(docs)).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r["doc_id"], r["size"]) for r in got), key=key) == sorted(((i, size(t)) for i, t, *_ in rows), key=key)
    names = sorted({s for *_, s in rows if s is not None}) + [None]
    sizes = {s: sum(size(t) for _, t, _, x in rows if x == s) for s in names}
    want = by_hand(sizes, {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)})
    for s in names:
        mine = [r for r in got if r["source"] == s]
        assert all(r["target"] == pytest.approx(want[s]) and r["source_size"] == sizes[s] for r in mine)
        # but for one document left open, the promised words are taken
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= max([r["size"] for r in mine], default=0)
    assert all(r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in got)
    again = mixing.mix(mixing.size_documents(docs.repartition(7))).collect()
    kept = ("doc_id", "size", "taken", "target")
    assert sorted((tuple(r[c] for c in kept) for r in again), key=key) == sorted((tuple(r[c] for c in kept) for r in got), key=key)


def test_expected_copies(shared):
    """Every document is as likely to be taken: over many sources of one make-up, shares are even."""
    rows = [(s * 10 + k, f"s{s:04d}", (1, 1, 2, 3, 5, 8, 8, 1, 1, 2)[k]) for s in range(300) for k in range(10)]
    sized = shared.createDataFrame(rows, "row_key long, source string, size long")
    targets = sized.groupBy("source").agg((F.sum("size") * 0.5).alias("target"), F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    got = mixing.copies_of(sized, targets).groupBy((F.col("row_key") % 10).alias("k")).agg(F.avg("copies").alias("p")).collect()
    assert all(abs(r["p"] - 0.5) < 0.12 for r in got)


def test_no_documents(documents):
    assert mixing.mix(mixing.size_documents(documents([]))).collect() == []


def test_main_path_is_native(documents, mixed_rows):
    plan = mixing.mix(mixing.size_documents(documents(mixed_rows)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_null_text_and_null_source_are_told_apart(documents):
    rows = [(1, None, "en", "t w o"), (1, "t w o", "en", None), (2, "a,b c", "en", "x"), (2, "c", "en", "x,=a,b ")]
    got = mixing.mix(mixing.size_documents(documents(rows))).collect()
    assert sorted((r["doc_id"], r["source"] or "", r["size"]) for r in got) == [(1, "", 3), (1, "t w o", 0), (2, "x", 2), (2, "x,=a,b ", 1)]
    assert len({bytes(r["row_key"]) for r in got}) == 4 and all(r["copies"] == 0 for r in got if not r["size"])
