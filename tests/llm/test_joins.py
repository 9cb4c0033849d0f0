"""Line dedup, Jaccard join, components and vector search against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import WORDS, prose
from docmonitor.llm import components, line_dedup, multi_index, token_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lines_by_hand(rows, least_sites, least_words):
    places = {}
    for n, (i, t, _, s) in enumerate(rows):
        for pos, line in enumerate((t or "").split("\n")):
            bare = line.strip(" \t\n\x0b\x0c\r")
            if len(WORD.findall(bare)) >= least_words:
                places.setdefault(bare, []).append((s, (i is not None, i, pos), n, pos))
    gone = set()
    for found in places.values():
        if len({s for s, *_ in found}) >= least_sites:
            first = min(found, key=lambda x: (x[1][0], x[1][1] or 0, x[1][2]))
            gone |= {(n, pos) for _, _, n, pos in found if (n, pos) != first[2:]}
    return [(i, t if t is None else "\n".join(x for pos, x in enumerate(t.split("\n")) if (n, pos) not in gone),
             sum((n, pos) in gone for pos in range(len((t or "").split("\n"))))) for n, (i, t, *_) in enumerate(rows)]


def test_line_dedup(documents, mixed_rows):
    shared = [prose(900 + k, 4 + k) for k in range(12)] + ["two words"]
    r = random.Random(4)
    rows = []
    for i in range(120):
        lines = [prose(i * 50 + k, 9) for k in range(4)] + [r.choice([" ", ""]) + x for x in r.sample(shared, r.randint(0, 6))]
        r.shuffle(lines)
        rows.append((i + 200, "\n".join(lines), "en", f"s{r.randint(0, 9) if i % 3 else 0}" if i % 11 else None))
    rows += mixed_rows[:-3] + mixed_rows[-1:]
    out = line_dedup.dedupe_lines(documents(rows))
    assert sorted(out.columns) == sorted([*documents([]).columns, "n_lines", "n_removed"])
    key = lambda x: (x[0] is None, x[0] or 0)
    got = sorted(((x["doc_id"], x["text"], x["n_removed"]) for x in out.collect()), key=key)
    assert got == sorted(lines_by_hand(rows, 4, 4), key=key)
    assert sum(x[2] for x in got) > 50


@pytest.mark.parametrize("sites", [2, 3, 5, 50])
def test_near_threshold_lines_are_counted_exactly(shared, sites):
    rows = [(n * 1000 + d, f"line {n}", f"site{d % n}") for n in (1, 2, 3, 4, 5, 6, 40, 48, 49, 50, 51, 52, 60) for d in range(2 * n)]
    lines = shared.createDataFrame(rows, "doc_id long, line string, site string").select(
        "doc_id", F.col("doc_id").alias("row_key"), "site", F.lit(0).alias("pos"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))
    got = {r["first"]["doc_id"] // 1000 for r in line_dedup.spread_lines(lines, sites).collect()}
    assert got == {n for n in (1, 2, 3, 4, 5, 6, 40, 48, 49, 50, 51, 52, 60) if n >= sites}


def test_line_dedup_of_nothing(documents):
    assert line_dedup.dedupe_lines(documents([])).collect() == []


def components_by_hand(rows, size, percent):
    def shingles(t):
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(t or "")]
        return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for n, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(n)] = min(i, least.get(find(n), i))
    return [(i, len(sets[n]), least.get(find(n)) if sets[n] else i) for n, (i, *_) in enumerate(rows)]


def near_rows():
    r = random.Random(8)
    rows = []
    for base in range(6):
        words = prose(base, 120).split()
        for copy in range(25 if base else 90):
            w = list(words)
            for _ in range(r.choice([0, 1, 2, 3, 5, 9])):
                w[r.randrange(len(w))] = r.choice(WORDS) + str(r.randrange(99))
            rows.append((len(rows) + 1000, " ".join(w).upper() if copy % 9 == 0 else " ".join(w), "en", f"s{copy % 4}"))
    passage = prose(321, 60)  # many unlike documents share it
    rows += [(len(rows) + 1000, prose(5000 + k, 60) + " " + passage, "en", "s1") for k in range(60)]
    return rows + [(5, "a b", "en", "s"), (6, "A  b", "en", "s"), (8, "a", "en", "s")]


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("hot, chunk", [(32, 128), (2, 7)])
def test_jaccard_join(documents, mixed_rows, monkeypatch, size, percent, hot, chunk):
    monkeypatch.setattr(token_groups, "HOT_COUNT", hot)
    monkeypatch.setattr(token_groups, "CHUNK_NODES", chunk)
    rows = near_rows() + mixed_rows
    got = token_groups.near_components(documents(rows), size, percent).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=key) == sorted(
        components_by_hand(rows, size, percent), key=key)


def test_two_families_of_many_chunks(documents, monkeypatch):
    """Members outside the largest component of their group still meet all its chunks."""
    monkeypatch.setattr(token_groups, "CHUNK_NODES", 20)
    r = random.Random(3)
    words, rows = prose(77, 90).split(), []
    passage = prose(78, 40)
    for n in range(400):
        w = list(words)
        if n % 4 == 0:  # a second family that shares most of its words with the first
            w[60:72] = prose(79, 12).split()
        w[r.randrange(len(w))] = f"x{n}"
        rows.append((n, " ".join(w), "en", "s"))
    rows += [(n, prose(9000 + n, 50) + " " + passage, "en", "s") for n in range(400, 600)]
    got = token_groups.near_components(documents(rows), 3, 90).collect()
    want = components_by_hand(rows, 3, 90)
    assert sorted((x["doc_id"], x["n_shingles"], x["component_id"]) for x in got) == sorted(want)
    assert len({c for *_, c in want}) < 500


def test_a_shared_passage_brings_few_groups_together(documents, monkeypatch):
    """Its tokens leave the prefixes, those too that come in when others leave."""
    r = random.Random(12)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(n, " ".join(f"w{r.randrange(10**9)}" for _ in range(90)) + " " + passage, "en", "s") for n in range(300)]
    seen, meetings = [], token_groups._meetings
    monkeypatch.setattr(token_groups, "_meetings", lambda shared, *rest: seen.append(shared) or meetings(shared, *rest))
    got = token_groups.near_components(documents(rows), 3, 90).collect()
    assert sorted((x["doc_id"], x["component_id"]) for x in got) == [(n, n) for n in range(300)]
    assert all(x["count"] < 30 for x in seen[0].groupBy("token").count().collect())


def test_rare_words_come_first():
    bits = {w: 2 for w in (b"the", b"of", b"and")}
    shingles = token_groups.Shingler(2, bits)
    rare, likely = shingles("Stone river"), shingles("of the")
    assert rare < likely and (shingles("and of stone RIVER of the")[0] == rare).all()
    assert len(shingles("the of the of the of")) == 2


def test_bounds_lose_no_pair():
    r = np.random.default_rng(2)
    sets = []
    for _ in range(40):
        base = np.unique(r.integers(0, 400, 60).astype(np.uint64))
        sets += [base, base[r.random(len(base)) > 0.1], np.union1d(base, r.integers(0, 400, 3).astype(np.uint64))]
    a, b = sets[::2], sets[1::2]
    for percent in (50, 80, 90):
        want = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b)
                if 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y))}
        assert set(map(tuple, token_groups.linked_pairs(a, b, percent).tolist())) == want


def test_join_of_nothing(documents):
    assert token_groups.near_components(documents([])).collect() == []
    assert [tuple(r)[1:] for r in token_groups.near_components(documents([(3, None, None, None)])).collect()] == [(3, 0, 3)]


def test_components(shared):
    r = random.Random(5)
    links = [(f"c{k:03d}", f"c{k + 1:03d}") for k in range(60)] + [("hub", f"h{k}") for k in range(80)]
    links += [(f"r{r.randrange(60)}", f"r{r.randrange(60)}") for _ in range(45)]
    r.shuffle(links)
    got = {x["node"]: x["root"] for x in components.components(shared.createDataFrame(links, "a string, b string")).collect()}
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components.components(shared.createDataFrame([], "a string, b string")).collect() == []


def vectors(n, dim, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, dim))
    return (centres[r.integers(0, 12, n)] + 0.4 * r.normal(size=(n, dim))).astype(np.float32)


SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int"


def nearest_by_hand(rows, k, every):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 6
          and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for i, v in ok:
        if i % every == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in ok if j != i)[:k]
            out += [(i, n + 1, j, d) for n, (d, j) in enumerate(near)]
    return out


def test_search_finds_all_where_all_are_seen(shared):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(300, 6, 1))]
    rows += [(400 + k, rows[3][1]) for k in range(40)]  # copies, queries among them
    rows += [(500, None), (501, [0.0] * 6), (502, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (503, [float("nan")] * 6), (None, rows[1][1]), (504, [1.0])]
    df = shared.createDataFrame([(i, v, 1, 0.5, 3) for i, v in rows], SCHEMA)
    got = multi_index.search(df, F.col("vec_id") % 20 == 0).collect()
    key = lambda x: x[:2]
    got, want = sorted(map(tuple, got), key=key), sorted(nearest_by_hand(rows, 10, 20), key=key)
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want], rtol=0, atol=1e-12)


def test_search_recall(shared):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(3000, 6, 2))]
    df = shared.createDataFrame([(i, v, 1, 0.5, 3) for i, v in rows], SCHEMA)
    got = {}
    for q, _, v, _ in multi_index.search(df, F.col("vec_id") % 50 == 0, least_seen=500, share=0.0).collect():
        got.setdefault(q, set()).add(v)
    want = nearest_by_hand(rows, 10, 50)
    assert sum(v in got[q] for q, _, v, _ in want) / len(want) >= 0.9


def test_recall_with_the_parameters_as_they_are(shared, monkeypatch):
    """Vectors of little structure, queries in several blocks; not all cells are opened."""
    r = np.random.default_rng(8)
    x = (r.normal(size=(6, 24))[r.integers(0, 6, 3000)] + 0.7 * r.normal(size=(3000, 24))).astype(np.float32).astype(float)
    df = shared.createDataFrame([(i, v.tolist(), 1, 0.5, 3) for i, v in enumerate(x)], SCHEMA)
    monkeypatch.setattr(multi_index, "CHUNK_QUERIES", 7)
    got, seen = {}, multi_index.search(df, F.col("vec_id") % 100 == 0).collect()
    for q, _, v, d in seen:
        got.setdefault(q, set()).add(v)
        assert abs(d - np.sqrt(((x[q] - x[v]) ** 2).sum())) < 1e-12
    hits = sum(len(got[q] & set(np.argsort(((x - x[q]) ** 2).sum(1), kind="stable")[1:11].tolist())) for q in range(0, 3000, 100))
    assert len(seen) == 300 and hits / 300 >= 0.9
    assert max(multi_index.LEAST_SEEN, multi_index.SEEN_SHARE * 3000) < 0.5 * 3000


def test_cells_are_walked_in_order():
    r = np.random.default_rng(3)
    d1, d2, counts = r.random(9), r.random(7), r.integers(0, 4, (9, 7))
    cells = multi_index.walk(d1, d2, counts, 10**9)
    sums = [d1[a] + d2[b] for a, b in cells]
    assert sums == sorted(sums) and set(cells) == {tuple(x) for x in np.argwhere(counts > 0).tolist()}
    few = multi_index.walk(d1, d2, counts, 12)
    assert few == cells[:len(few)] and sum(counts[c] for c in few) >= 12 > sum(counts[c] for c in few[:-1])


def test_search_of_nothing(shared):
    assert multi_index.search(shared.createDataFrame([], SCHEMA), F.col("vec_id") % 2 == 0).collect() == []
    one = shared.createDataFrame([(2, [1.0, 2.0], 1, 0.5, 3)], SCHEMA)
    assert multi_index.search(one, F.col("vec_id") % 2 == 0).collect() == []
