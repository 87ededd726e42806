"""Exact top-k that reads less: block bounds, sorted lists in growing depth, pivot distances."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from martlet.operators import search
from martlet.operators.blockmax import BlockIndex
from martlet.operators.fusion import fused_top
from martlet.operators.pivots import PivotIndex

WORDS = [f"w{i}" for i in range(40)]


def texts(seed, n):
    r = random.Random(seed)
    out = [(i, r.choice(["en", "fr"]), " ".join(r.choices(WORDS, [1 / (1 + j) for j in range(40)], k=r.randrange(1, 60)))) for i in range(n)]
    return out + [(n, "en", None), (n + 1, "en", ""), (n + 2, "en", "w39 w38 w37"), (n + 3, "fr", "w39 w38 w37")]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    docs = spark.createDataFrame(texts(1, 600), "id long, lang string, body string")
    index = BlockIndex(spark, str(tmp_path_factory.mktemp("blocks")), "id", ["lang"])
    index.build(docs, "body", 8)
    return docs, index


@pytest.mark.parametrize("question", ["w39 w38", "w0", "w1 w39 w39 never", "never", "", "w0 w1 w2 w3 w4 w5"])
def test_blocks_give_the_same_documents(spark, indexed, question):
    docs, index = indexed
    terms = index._terms(question)
    for equal in (None, {"lang": "fr"}):
        whole = search.bm25(search.postings(docs, "id", "body", ["lang"]), search.statistics(docs, "body"), terms, "id", equal)
        assert index.top(question, 10, equal).scores.collect() == search.top(whole, "id", 10).collect()


def test_blocks_that_cannot_reach_are_skipped(indexed):
    found = indexed[1].top("w39 w38 w37 w0", 3)
    assert found.blocks > 60 and found.read < 0.6 * found.blocks


def test_blocks_of_no_documents(spark, tmp_path):
    index = BlockIndex(spark, str(tmp_path / "none"), "id")
    index.build(spark.createDataFrame([], "id long, body string"), "body")
    assert index.top("w1", 5).scores.count() == 0


# ---- fusion ----------------------------------------------------------------------------------

scores = st.dictionaries(st.integers(0, 40), st.integers(0, 6), max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=scores, b=scores, k=st.integers(1, 6), depth=st.integers(1, 9))
def test_fusion_from_heads_equals_fusion_of_whole_lists(spark, a, b, k, depth):
    lists = [spark.createDataFrame([(i, float(s)) for i, s in x.items()], "id long, score double").coalesce(2) for x in (a, b)]
    got = fused_top(*lists, "id", k, depth).scores
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in search.top(search.fuse(*lists, "id"), "id", k).collect()]


def test_fusion_reads_a_part_of_long_lists(spark):
    r = random.Random(5)
    lists = [spark.createDataFrame([(i, r.random()) for i in range(5000)], "id long, score double") for _ in range(2)]
    found = fused_top(*lists, "id", 5)
    assert found.depth < 1000 and found.counted < 200
    assert rows(found.scores) == rows(search.top(search.fuse(*lists, "id"), "id", 5))


# ---- pivots ----------------------------------------------------------------------------------


def clustered(seed, n, width=6, groups=12):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(width)] for _ in range(groups)]
    out = [(i, r.choice("xy"), [c + r.gauss(0, 0.05) for c in centres[i % groups]]) for i in range(n)]
    return out + [(n, "x", None), (n + 1, "x", [0.0] * width), (n + 2, "y", [1.0, None] + [0.0] * (width - 2)), (n + 3, "x", out[0][2])], centres


def test_pivots_give_the_same_vectors(spark, tmp_path):
    data, centres = clustered(1, 900)
    vectors = spark.createDataFrame(data, "id long, c string, v array<float>")
    index = PivotIndex(spark, str(tmp_path / "p"), "id", "v", ["c"])
    index.build(vectors, pivots=6)
    r = random.Random(2)
    for query in [data[0][2], [c + 0.1 for c in centres[3]], [r.gauss(0, 1) for _ in range(6)], [-c for c in centres[0]]]:
        for equal in (None, {"c": "y"}):
            want = search.top(search.vector_scores(vectors, "id", "v", query, equal), "id", 7)
            assert index.top(query, 7, equal).collect() == want.collect()
    assert index.top(data[0][2], 2000).count() == 901


def test_row_groups_that_pivots_exclude_are_not_read(spark, tmp_path):
    data, centres = clustered(3, 4000)
    index = PivotIndex(spark, str(tmp_path / "p"), "id", "v")
    index.build(spark.createDataFrame(data, "id long, c string, v array<float>"), pivots=12, rows_per_file=250)
    near = index.near(centres[5], 0.3)
    assert "PushedFilters: [" in near._jdf.queryExecution().executedPlan().toString()
    away = index._away(centres[5])
    read = total = 0
    for file in glob.glob(f"{index.path}/vectors/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            stats = {group.column(c).path_in_schema: group.column(c).statistics for c in range(group.num_columns)}
            total += 1
            read += all(stats[f"_d{i}"].min <= d + 0.3 and stats[f"_d{i}"].max >= d - 0.3 for i, d in enumerate(away))
    assert total >= 14 and read <= total / 3
    assert near.count() < 4000 / 3


def test_pivots_of_no_vectors(spark, tmp_path):
    index = PivotIndex(spark, str(tmp_path / "none"), "id", "v")
    index.build(spark.createDataFrame([(1, None)], "id long, v array<float>"))
    assert index.top([1.0, 0.0], 3).count() == 0
