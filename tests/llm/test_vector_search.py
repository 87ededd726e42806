import math

import numpy as np
import pytest

from martlet.llm import learned_partitions, norm_search

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=1, n=900, width=12):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(8, width)) * 3
    data = (centres[r.integers(0, 8, n)] + r.normal(size=(n, width))) * r.lognormal(0, 0.7, (n, 1))
    rows = [(i, x.astype("float32").tolist(), 0) for i, x in enumerate(data)]
    same = rows[7][1]
    rows += [(n + i, same, 1) for i in range(40)]
    return rows + [
        (2000, None, 1), (2001, [], 1), (2002, [0.0] * width, 1), (2003, [1.0, None] + [0.0] * (width - 2), 1),
        (2004, [float("nan")] * width, 1), (2005, [float("inf")] + [0.0] * (width - 1), 1), (None, rows[3][1], 1),
        (100, rows[100][1], 1), (2100, [2.5, -1.0], 1)]


def usable(x, zero):
    return x is not None and all(v is not None and math.isfinite(v) for v in x) and (zero or any(v != 0 for v in x))


def brute(rows, score, zero, k=10):
    rows = [(i, np.array(x, float)) for i, x, _ in rows if usable(x, zero)]
    width = max((len(x) for _, x in rows), default=0)
    data = np.array([np.pad(x, (0, width - len(x))) for _, x in rows]).reshape(len(rows), width)
    out = []
    for at, (query, _) in enumerate(rows):
        if query is None or query % 100:
            continue
        values = score(data, data[at])
        order = sorted((j for j in range(len(rows)) if j != at), key=lambda j: (
            values[j], math.inf if rows[j][0] is None else rows[j][0]))[:k]
        out += [(query, rank, rows[j][0], values[j]) for rank, j in enumerate(order, 1)]
    return sorted(out, key=repr)


def test_products_equal_brute_force(spark):
    for rows, bucket in ((vectors(), 64), (vectors(2, 300), 2048), ([(0, [1.0], 1), (5, [2.0], 1)], 8)):
        got = norm_search.top_products(spark.createDataFrame(rows, SCHEMA).repartition(5), bucket=bucket).collect()
        want = brute(rows, lambda d, q: [-int(v) for v in np.floor(1024 * d) @ np.floor(1024 * q)], True)
        assert sorted(map(tuple, got), key=repr) == sorted(((a, b, c, -s) for a, b, c, s in want), key=repr)


@pytest.mark.parametrize("size", [1e5, 2e5, 3e6, 1e7, 1e12])
def test_large_products_are_exact(spark, size):
    """Products beyond 53 bits are exact, beyond a long the largest or smallest one; no row is lost."""
    r = np.random.default_rng(8)
    rows = [(i, (r.normal(size=64) * size).tolist()) for i in range(60)] + [(61, [0.5] * 64), (62, [0.25] * 64)]
    got = norm_search.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), every=20, bucket=16)
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    most = 2**63 - 1
    want = []
    for i, q in whole:
        if i % 20 == 0:
            scores = sorted((-min(max(sum(a * b for a, b in zip(q, v)), -most), most), j) for j, v in whole if j != i)
            want += [(i, n, j, -s) for n, (s, j) in enumerate(scores[:10], 1)]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_pruning_never_loses_a_vector():
    r = np.random.default_rng(4)
    skipped = 0
    for _ in range(200):
        data = r.normal(size=(80, 6)) * r.lognormal(0, 0.5, (80, 1))
        lengths = np.sqrt((data**2).sum(1))
        data = data[np.argsort(-lengths)]
        lengths = np.sort(lengths)[::-1]
        query = r.normal(size=6)
        bound = float(np.sort(data @ query)[-3])
        near = norm_search.select(data / lengths[:, None], lengths, query, bound)
        assert set(np.flatnonzero(data @ query >= bound)) <= set(near)
        skipped += 80 - len(near)
    assert skipped > 4000


def test_nearest_is_exact_with_all_parts(spark):
    rows = vectors()
    got = learned_partitions.nearest(spark.createDataFrame(rows, SCHEMA), parts=8, probes=8, sample=400).collect()
    want = brute(rows, lambda d, q: np.sqrt(((d - q) ** 2).sum(1)).tolist(), False)
    got = sorted((tuple(r) for r in got), key=lambda r: repr(r[:3]))
    want = sorted(want, key=lambda r: repr(r[:3]))
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])


def test_recall_of_the_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, 0) for r in docs.collect()]
    want = {(a, c) for a, _, c, _ in brute(rows, lambda d, q: ((d - q) ** 2).sum(1).tolist(), False)}
    got = {(r.query_id, r.vec_id) for r in learned_partitions.nearest(docs).collect()}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def searched(data, queries):
    """Recall of 10 nearest and share of all vectors that queries are compared with."""
    router = learned_partitions.train(data[:4096], 32)
    part = router.ordered(data)[0][:, 0]
    found = shared = 0
    for query, parts in zip(queries, router.route(queries)):
        near = np.argsort(((data - query) ** 2).sum(1))[:10]
        found += np.isin(part[near], parts).mean()
        shared += np.isin(part, parts).mean()
    return found / len(queries), shared / len(queries)


def test_few_parts_are_searched_where_vectors_have_clusters():
    r = np.random.default_rng(12)
    centres = r.normal(size=(200, 24))
    draw = lambda n: centres[r.integers(0, 200, n)] + 0.35 * r.normal(size=(n, 24))
    recall, share = searched(draw(8000), draw(100))
    assert recall >= 0.93 and share <= 0.35
    recall, share = searched(r.normal(size=(8000, 24)), r.normal(size=(100, 24)))  # no clusters: more is searched
    assert recall >= 0.9 and share > 0.35


def test_parts_grow_with_the_table():
    assert [learned_partitions.parts_for(n) for n in (0, 10**6, 10**7, 10**12)] == [32, 32, 128, 128]


def test_a_row_is_routed_alike_in_any_batch():
    data = np.random.default_rng(3).normal(size=(500, 8))
    router = learned_partitions.train(data, 8)
    whole = router.ordered(data)[0]
    assert all((router.ordered(data[i:i + n])[0] == whole[i:i + n]).all() for i, n in ((0, 1), (7, 64), (100, 65), (3, 400)))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert norm_search.top_products(none).count() == 0 and learned_partitions.nearest(none).count() == 0
    only = spark.createDataFrame([(100, [1.0, 2.0], 1)], SCHEMA)
    assert norm_search.top_products(only).count() == 0 and learned_partitions.nearest(only).count() == 0


def test_partition_is_balanced_and_learned():
    r = np.random.default_rng(5)
    data = np.repeat(r.normal(size=(8, 10)) * 4, 50, 0) + r.normal(size=(400, 10))
    labels = learned_partitions.partition(learned_partitions.neighbour_graph(data, 10), 8)
    assert set(np.bincount(labels).tolist()) == {50}
    router = learned_partitions.Router(8, 10).fit(data, labels, np.eye(8)[labels])
    assert (router.ordered(data)[0][:, 0] == labels).mean() > 0.9
