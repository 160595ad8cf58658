import hashlib
import math
import random

import numpy as np
import pytest

from vehiscope.llm import centroids as C

from .conftest import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, dims=64, k=16, rounds=3):
    """All distances, in whole numbers of any size."""
    kept = [(i, [math.floor(64.0 * v) for v in e]) for i, e in rows
            if e is not None and len(e) == dims and all(v is not None and math.isfinite(v) for v in e)]
    first = sorted(((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None))[:k]
    cents = [v for _, v in first]
    if not cents:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, vs in groups.items():
            cents[j] = [sum(col) // len(vs) for col in zip(*vs)]
    out = [(i, *nearest(v)) for i, v in kept]
    per = {}
    for _, d, j in out:
        per[j] = per.get(j, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, j, d, per[j], sum(per.values()), digest[j]) for i, d, j in out), key=str)


def vectors(rng, n, dims=64):
    return [(i, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(dims)]) for i in range(n)]


def run(spark, rows, parts=3, **kw):
    df = spark.createDataFrame([(i, e, 1) for i, e in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in C.cluster(df, **kw).collect()), key=str)


def test_equals_all_distances(spark):
    rows = vectors(random.Random(3), 300)
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    rng = random.Random(4)
    rows = vectors(rng, 40)
    same = rows[0][1]
    rows += [(0, same), (500, same), (501, None), (502, []), (503, same[:63]), (504, same + [1.0]),
             (505, same[:63] + [None]), (506, same[:63] + [float("nan")]), (507, same[:63] + [float("inf")]),
             (None, same), (None, None), (508, [0.0] * 64), (509, [-0.01] * 64)]
    assert run(spark, rows) == brute(rows)
    assert [r[0] for r in run(spark, rows)].count(0) == 2


def test_ties_take_the_smaller_number():
    b = C.Bisectors([[0, 0], [4, 0], [0, 0], [2, 2]])
    x = np.array([[2, 0], [3, 0], [0, 0], [1, 1], [2, 5]])
    assert b.nearest(x).tolist() == [0, 1, 0, 0, 3]
    assert b.distances(x, b.nearest(x)).tolist() == [4, 1, 0, 2, 9]


def test_whole_numbers_beyond_doubles():
    rng = random.Random(8)
    points = [[rng.randrange(-C.LARGEST, C.LARGEST) for _ in range(64)] for _ in range(9)]
    points.append([v + (k == 5) for k, v in enumerate(points[0])])
    x = [[p + rng.randrange(2) for p in points[rng.randrange(10)]] for _ in range(60)]
    want = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(points)) for v in x]
    b = C.Bisectors(points)
    near = b.nearest(np.array(x))
    assert list(zip(b.distances(np.array(x), near).tolist(), near.tolist())) == want


def test_huge_components_are_held(spark):
    rows = vectors(random.Random(6), 20) + [(90, [3e38] * 64), (91, [-3e38] * 64)]
    held = [(i, [max(min(v, C.LARGEST / 64), -C.LARGEST / 64) for v in e]) for i, e in rows]
    got = run(spark, rows)
    assert [r[:3] for r in got] == [r[:3] for r in brute(held)]


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    rows = vectors(random.Random(n), n)
    assert run(spark, rows) == brute(rows)


def test_clashing_columns(spark):
    rows = vectors(random.Random(1), 30)
    df = clashing(spark.createDataFrame([(i, e, 1) for i, e in rows], SCHEMA), "cluster", "distance", "c", "n", "s", "h")
    assert sorted((tuple(r) for r in C.cluster(df).collect()), key=str) == brute(rows)
