"""Mergeable states: distinct counts from bitmaps, quality checks batch by batch; clustering along a curve."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from martlet.operators import layout, rollup
from martlet.operators.files import delete, folders
from martlet.operators.quality_state import QualityStates

# ---- distinct counts -------------------------------------------------------------------------


def test_bitmap_counts_equal_distinct_counts(spark):
    r = random.Random(1)
    data = [(r.randrange(4), r.choice("ab"), None if r.random() < 0.1 else f"e{r.randrange(70_000)}") for _ in range(60_000)]
    df = spark.createDataFrame(data, "day int, c string, e string")
    first, second = df.where("day < 2"), df.where("day >= 2")
    numbers = rollup.number_values(first, "e")
    more = rollup.number_values(second, "e", numbers)
    assert more.count() == more.select("_number").distinct().count() == more.agg(F.max("_number")).first()[0]
    both = rollup.rollup(first, ["day", "c"], "e", numbers).unionByName(rollup.rollup(second, ["day", "c"], "e", more))
    assert both.select("_range").distinct().count() > 1  # more than one bitmap's worth of numbers
    for by in (["day", "c"], ["c"], []):
        got = rollup.distinct_counts(both, by, "n")
        assert rows(got) == rows(df.where("e IS NOT NULL").groupBy(*by).agg(F.count_distinct("e").alias("n")))
        assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_bitmaps_of_no_rows(spark):
    none = spark.createDataFrame([], "day int, e string")
    numbers = rollup.number_values(none, "e")
    assert rollup.distinct_counts(rollup.rollup(none, ["day"], "e", numbers), [], "n").first()["n"] == 0


# ---- quality states --------------------------------------------------------------------------

row = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.sampled_from("xyz")), st.sampled_from("pq"))
SCHEMA = "k int, v string, w string"


def full_check(df):
    out = [("rows", "*", df.count()), ("nulls", "v", df.where("v IS NULL").count())]
    out.append(("duplicate keys", "k, w", df.groupBy("k", "w").count().where("count > 1").count()))
    distinct = df.agg(F.count_distinct("v")).first()[0]
    out += [("distinct values", "v", distinct)] if distinct else []
    if df.count():
        combos = df.select("v", "w").distinct().groupBy("v").count()
        out.append(("inconsistent", "v", combos.where("count > 1").count()))
    return sorted(out, key=repr)


def states_of(spark, path):
    return QualityStates(
        spark, path, spark.createDataFrame([], SCHEMA).schema, ["k", "w"], ["v"], ["v"], {"v": ["w"]}, parts=2)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.lists(row, max_size=8), min_size=3, max_size=3), fold=st.booleans())
def test_states_equal_the_full_check(spark, tmp_path_factory, batches, fold):
    states, seen = states_of(spark, str(tmp_path_factory.mktemp("q") / "s")), []
    for n, data in enumerate(batches, 1):
        assert states.add(n, spark.createDataFrame(data, SCHEMA))
        assert not states.add(n, spark.createDataFrame([(1, "x", "p")], SCHEMA))
        seen += data
        assert sorted(map(tuple, states.findings().collect()), key=repr) == full_check(spark.createDataFrame(seen, SCHEMA))
        if fold and n == 2:
            assert states.fold() == 2 and folders(spark, states.path) == ["upto=2"]


def test_only_the_new_batch_is_read(spark, tmp_path):
    states = states_of(spark, str(tmp_path / "s"))
    for n in range(1, 4):
        where = str(tmp_path / f"rows{n}")
        spark.createDataFrame([(i, "x", "p") for i in range(n)], SCHEMA).write.parquet(where)
        states.add(n, spark.read.parquet(where))
        delete(spark, where)  # the rows are gone; what they left is enough
    found = {(r.check, r.name): r.found for r in states.findings().collect()}
    assert found[("rows", "*")] == 6 and found[("duplicate keys", "k, w")] == 2


# ---- layout ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def lines(spark):
    r = random.Random(3)
    data = [(i, r.randrange(90), r.choice("abcdefgh")) for i in range(6000)]
    return spark.createDataFrame(data, "id int, day int, c string").withColumn("day", F.date_add(F.lit("2026-01-01").cast("date"), F.col("day")))


def test_a_curve_prunes_on_either_column(spark, lines, tmp_path):
    by = [F.col("day"), F.col("c")]
    layout.clustered(lines, by, ["id"], 200).write.parquet(str(tmp_path / "plain"))
    layout.clustered_curve(lines, by, ["id"], 200).write.parquet(str(tmp_path / "curve"))
    plain, curve = (spark.read.parquet(str(tmp_path / n)) for n in ("plain", "curve"))
    assert rows(curve) == rows(lines)
    category = [layout.files_to_read(t, F.col("c"), "d", "d") for t in (plain, curve)]
    assert category[1] < category[0] / 2
    day = layout.files_to_read(curve, F.col("day"), *[F.lit("2026-02-01").cast("date")] * 2)
    assert day < layout.file_ranges(curve, F.col("day")).count() / 2


def test_interleaving(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    place = {(r.a, r.b): r.z for r in df.select("a", "b", layout.interleaved([F.col("a"), F.col("b")], 2).alias("z")).collect()}
    assert sorted(place.values()) == list(range(16))
    assert [place[p] for p in ((0, 0), (0, 1), (1, 0), (1, 1), (0, 2), (2, 0), (3, 3))] == [0, 1, 2, 3, 4, 8, 15]


def test_curve_of_nulls_one_value_and_no_rows(spark):
    schema = "id int, a int, c string"
    for data in ([], [(1, None, None)], [(i, 7, None if i % 2 else "x") for i in range(20)]):
        df = spark.createDataFrame(data, schema)
        assert rows(layout.clustered_curve(df, [F.col("a"), F.col("c")], ["id"], 5)) == rows(df)
