"""Scalar-table clustering against plain integer arithmetic."""

import hashlib
import random

import numpy as np
import pytest

from docmonitor.llm import scalar_clusters as S


def by_hand(rows, count, rounds, width):
    kept = []
    for i, x in rows:
        if x is not None and len(x) == width and all(c is not None and abs(c) < float("inf") for c in x):
            kept.append((i, [int(np.floor(64 * c)) for c in x]))
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:count]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(near(v)[1], []).append(v)
        for k, vs in members.items():
            centroids[k] = [sum(col) // len(vs) for col in zip(*vs)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    total = {}
    for _, k, d in found:
        total[k] = total.get(k, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, total[k], sum(total.values()), digest[k]) for i, k, d in found), key=repr)


def table(shared, rows):
    return shared.createDataFrame([(i, x, 3, "v") for i, x in rows], "vec_id long, embedding array<double>, cluster int, v string").repartition(3)


@pytest.mark.parametrize("seed,spread", [(0, 1.0), (1, 1.0), (2, 3000.0)])
def test_clusters(shared, seed, spread):
    r = random.Random(seed)
    rows = [(i, [spread * round(r.uniform(-1, 1), 3) for _ in range(6)]) for i in range(160)]
    rows += [(400 + i, rows[0][1]) for i in range(40)] + [rows[5], rows[5], (None, rows[7][1]), (500, None), (501, []), (502, [1.0] * 5),
             (503, [1.0] * 7), (504, [1.0] * 5 + [None]), (505, [1.0] * 5 + [float("nan")]), (506, [1.0] * 5 + [float("-inf")])]
    got = S.cluster(table(shared, rows), count=7, rounds=3, dimensions=6)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(rows, 7, 3, 6)


def test_empty_clusters_stay(shared):
    rows = [(i, [0.5, 0.5]) for i in range(9)] + [(20, [0.25, -0.25])]
    got = S.cluster(table(shared, rows), count=4, dimensions=2).collect()
    assert sorted(map(tuple, got), key=repr) == by_hand(rows, 4, 3, 2)


def test_fewer_vectors_than_centroids(shared):
    rows = [(1, [0.1, -0.1]), (2, [0.9, 0.3])]
    got = S.cluster(table(shared, rows), dimensions=2).collect()
    assert sorted(map(tuple, got), key=repr) == by_hand(rows, 16, 3, 2) and all(r["distance"] == 0 for r in got)


def test_clusters_of_nothing(shared):
    assert S.cluster(table(shared, [])).collect() == []
    assert S.cluster(table(shared, [(1, [1.0])])).collect() == []


def test_too_large_components_stop(shared):
    with pytest.raises(Exception, match="too large"):
        S.cluster(table(shared, [(1, [1e12, 0.0])]), dimensions=2).collect()


def test_sparse_integers_have_tables_too():
    values = np.array([[-(10 ** 8), 5], [10 ** 8, 5], [3, 4]])
    best, distance = S.nearest(values, np.array([[3, 4], [10 ** 8, 5]]))
    assert best.tolist() == [0, 1, 0] and distance.tolist() == [(10 ** 8 + 3) ** 2 + 1, 0, 0]
