import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martlet.llm import centroid_search
from martlet.llm.centroid_search import Search, _exact, moments

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, k=8, rounds=10, width=64, seed=3):
    """The contract in Python integers, with a full search."""
    kept = [
        (i, [math.floor(1024 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: (i is None, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() if i is not None else "")
    centroids = [v for i, v in sorted(kept, key=lambda r: (*name(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            own = [v for (_, v), c in zip(kept, of) if c == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    sums = {n: sum(d for _, c, d in found if c == n) for n in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    long = lambda x: x if x < 2**63 else None
    whole = long(sum(sums.values()))
    return sorted(((i, c, long(d), long(sums[c]), whole, sha[c]) for i, c, d in found), key=repr)


def rows_of(spark, rows, **how):
    found = centroid_search.cluster(spark.createDataFrame(rows, SCHEMA).repartition(3), **how)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def vectors(seed, n, width, size=1.0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(5, width)) * size * 2
    return [(i, (centres[i % 5] + r.normal(size=width) * size).tolist()) for i in range(n)]


def test_equals_a_full_search(spark):
    rows = vectors(1, 120, 64) + [
        (500, None), (501, []), (502, [0.5] * 63), (503, [0.5] * 65), (504, [None] + [0.5] * 63), (505, [math.nan] * 64),
        (506, [math.inf] + [0.0] * 63), (507, [0.0] * 64), (508, [0.0] * 64), (None, [0.25] * 64), (None, [0.125] * 64),
        (7, [1.0] * 64), (7, [1.0] * 64)]
    assert rows_of(spark, rows) == plain(rows)


@pytest.mark.parametrize("size", [1e5, 3e6, 1e12])
def test_large_components(spark, size):
    """Whole numbers of any size: no overflow, and null where a distance is no long."""
    rows = vectors(2, 40, 4, size)
    got = rows_of(spark, rows, k=3, rounds=4, width=4)
    assert got == plain(rows, 3, 4, 4)
    assert (got[0][4] is None) == (size > 1e6)


def test_ties_few_vectors_and_no_vectors(spark):
    same = [(i, [1.0, 2.0]) for i in range(30)] + [(40, [3.0, 2.0])]
    assert rows_of(spark, same, k=4, rounds=3, width=2) == plain(same, 4, 3, 2)
    two = [(5, [1.0, -2.5]), (6, [-1.0, 0.5])]
    assert rows_of(spark, two, width=2) == plain(two, width=2)
    assert rows_of(spark, [], width=2) == rows_of(spark, [(1, None)], width=2) == []


def test_other_columns_are_not_read(spark):
    rows = [(i, v, i, "x") for i, v in vectors(3, 20, 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, `cluster` int, `a.b` string")
    got = centroid_search.cluster(table, width=2).collect()
    assert sorted(map(tuple, got), key=repr) == plain([r[:2] for r in rows], width=2)


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12), st.integers(1, 6), st.sampled_from([2, 50, 10**6, (1 << 29) // 6, 1 << 30, 1 << 40]))
def test_search_never_misses(seed, k, width, size):
    r = np.random.default_rng(seed)
    data, centroids = r.integers(-size, size, (40, width)), r.integers(-size, size, (k, width))
    total, deviation = moments(_exact(data))
    number, best = Search(centroids).nearest(data, total.astype(object), deviation)
    full = ((data[:, None].astype(object) - centroids[None].astype(object)) ** 2).sum(2)
    assert number.tolist() == [min(range(k), key=lambda c: (row[c], c)) for row in full]
    assert best.tolist() == [min(row) for row in full]


def test_search_computes_fewer_distances():
    r = np.random.default_rng(6)
    centroids = r.integers(-1000, 1000, (32, 8))
    data = centroids[r.integers(0, 32, 500)] + r.integers(-20, 20, (500, 8))
    search = Search(centroids)
    total, deviation = moments(_exact(data))
    search.nearest(data, total.astype(object), deviation)
    assert search.computed < 500 * 32 / 4
