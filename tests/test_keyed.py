"""Keyed tables: merges, feeds between batches, bucketed reads; aggregates that follow their changes."""

import glob
import pathlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from martlet.operators.keyed import HASH, KeyedTable, key_hash
from martlet.operators.maintained import MaintainedAggregate, Measure

SCHEMA = T.StructType([
    T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()), T.StructField("g", T.StringType()),
    T.StructField("v", T.LongType()), T.StructField("d", T.DecimalType(12, 2))])
KEY = ["a", "b"]


def at(n):
    return F.lit(f"2026-01-01 00:00:{n:02d}").cast("timestamp_ntz")


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), SCHEMA, KEY, 4)


def frame(spark, data):
    return spark.createDataFrame([(a, b, g, v, None if v is None else v) for a, b, g, v in data], "a string, b int, g string, v long, d long")


def state_of(table):
    return {(r.a, r.b): (r.g, r.v) for r in table.state().collect()}


def merge(table, n, upserts=(), deletes=(), **how):
    spark = table.spark
    gone = spark.createDataFrame([(*k, None, None, None) for k in deletes], "a string, b int, g string, v long, d long")
    return table.merge(n, frame(spark, upserts), gone, at(n), **how)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_update_delete_and_replay(table):
    assert table.last_batch() is None and table.state().count() == 0
    assert merge(table, 1, [("x", 1, "p", 1), ("x", None, "p", 2), (None, None, None, 3)])
    assert merge(table, 2, [("x", 1, "q", 9), ("y", 1, "p", None)], [(None, None)])
    want = {("x", 1): ("q", 9), ("x", None): ("p", 2), ("y", 1): ("p", None)}
    assert state_of(table) == want
    assert not merge(table, 2, [("x", 1, "zz", 0)]) and not merge(table, 1, [("x", 1, "zz", 0)])
    assert table.fold() == 2 and table.fold() == 2 and state_of(table) == want
    inserted = {(r.a, r.b): r.inserted_at.second for r in table.state().collect()}
    assert inserted == {("x", 1): 1, ("x", None): 1, ("y", 1): 2}
    assert merge(table, 3, [(None, None, "back", 4)], [("x", None)])
    assert state_of(table) == {("x", 1): ("q", 9), ("y", 1): ("p", None), (None, None): ("back", 4)}


def test_insert_only_and_update_only(table):
    merge(table, 1, [("x", 1, "p", 1), (None, 1, "p", 1)])
    table.fold()
    merge(table, 2, [("x", 1, "q", 2), (None, 1, "q", 2), ("n", 1, "q", 2)], update=False)
    assert state_of(table) == {("x", 1): ("p", 1), (None, 1): ("p", 1), ("n", 1): ("q", 2)}
    merge(table, 3, [("x", 1, "r", 3), ("m", 1, "r", 3)], insert=False)
    assert state_of(table) == {("x", 1): ("r", 3), (None, 1): ("p", 1), ("n", 1): ("q", 2)}
    merge(table, 4, [("x", 1, "r", 3)])  # nothing changes, yet the batch is known
    assert table.last_batch() == 4 and table.feed(3, 4).count() == 0


def test_feed_is_net_and_reads_its_batches_only(table):
    merge(table, 1, [("a", 1, "p", 1), ("b", 1, "p", 1), (None, None, "p", 1)])
    merge(table, 2, [("c", 1, "p", 1), ("a", 1, "p", 2)])
    merge(table, 3, [("a", 1, "p", 3)], [("c", 1), (None, None)])
    merge(table, 4, [("b", 1, "p", 5)])
    found = sorted(((r.a, r.b, r.v, r._action, r._is_update) for r in table.feed(1, 3).collect()), key=repr)
    assert found == sorted([
        ("a", 1, 1, "DELETE", True), ("a", 1, 3, "INSERT", True), (None, None, 1, "DELETE", False)], key=repr)
    # Batches outside the span are not opened: the feed stands when their files are spoilt.
    for spoilt in (1, 4):
        for file in glob.glob(f"{table.path}/changes/_batch={spoilt}/*.parquet"):
            pathlib.Path(file).write_bytes(b"spoilt")
    assert sorted(((r.a, r.b, r.v, r._action, r._is_update) for r in table.feed(1, 3).collect()), key=repr) == found
    text = plan(table.feed(1, 3))
    assert "(_batch" in text.split("PartitionFilters")[1] and "full" not in text.lower().replace("fullouter", "full")


def test_base_is_not_shuffled_and_lookups_open_few_buckets(spark, table):
    merge(table, 1, [(f"k{i}", i, "p", i) for i in range(200)])
    table.fold()
    merge(table, 2, [("k1", 1, "q", 0), ("new", 0, "q", 0)])
    text = plan(table.state())
    scan = [i for i, line in enumerate(text.splitlines()) if "keyed_" in line][0]
    above = "\n".join(text.splitlines()[:scan])
    assert "Bucketed: true" in text and "Exchange" not in above.split("SortMergeJoin")[1]
    keys = frame(spark, [("k7", 7, None, None)]).select(key_hash(KEY).alias(HASH), *KEY)
    bucket = keys.select(F.expr(f"pmod(hash({HASH}), 4)")).first()[0]
    others = [f for f in glob.glob(f"{table.path}/base/upto=1/*.parquet") if f"_{bucket:05d}." not in f]
    assert len(others) == 3
    for file in others:
        pathlib.Path(file).write_bytes(b"spoilt")
    found = table.lookup(keys)
    assert "PushedFilters: [IsNotNull(_hash), EqualTo(_hash," in plan(found)
    assert [(r.a, r._row.v) for r in found.collect()] == [("k7", 7)]


def test_batches_meet_each_other_and_the_base_in_their_buckets(spark, table):
    merge(table, 1, [(f"k{i}", i, "p", i) for i in range(50)])
    assert "Exchange" not in plan(table.feed(0, 1)) and "Aggregate" not in plan(table.feed(0, 1))  # one batch is net
    table.fold()
    merge(table, 2, [("k1", 1, "q", 0), (None, None, "q", 1)])
    merge(table, 3, [("k1", 1, "r", 0)], [(None, None)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(table.state()) and "Exchange" not in plan(table.feed(1, 3))
        assert state_of(table) == {(f"k{i}", i): ("p", i) for i in range(50)} | {("k1", 1): ("r", 0)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_keys_are_joined_instead(spark, table):
    merge(table, 1, [(f"k{i}", i, "p", i) for i in range(50)])
    table.fold()
    spark.conf.set("spark.martlet.lookupKeys", "3")
    try:
        merge(table, 2, [(f"k{i}", i, "q", i) for i in range(40)], [("k45", 45)])
        assert sum(g == "q" for g, _ in state_of(table).values()) == 40 and len(state_of(table)) == 49
    finally:
        spark.conf.unset("spark.martlet.lookupKeys")


def test_expired_batches_cannot_be_fed(table):
    for n in (1, 2, 3):
        merge(table, n, [("x", n, "p", n)])
    table.fold()
    assert table.expire(2) == [1, 2] and len(state_of(table)) == 3
    assert table.feed(2, 3).count() == 1
    with pytest.raises(ValueError):
        table.feed(1, 3)


MEASURES = {
    "n": Measure("count"), "n_v": Measure("count", "v"), "total": Measure("sum", "v"), "amount": Measure("sum", "d"),
    "least": Measure("min", "v"), "most": Measure("max", "v"), "kinds": Measure("distinct", "a")}


def batch_query(table):
    return table.state().groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.count("v").alias("n_v"), F.sum("v").alias("total"), F.sum("d").alias("amount"),
        F.min("v").alias("least"), F.max("v").alias("most"), F.count_distinct("a").alias("kinds"))


step = st.tuples(
    st.dictionaries(
        st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([1, None])),
        st.one_of(st.none(), st.tuples(st.sampled_from(["p", "q", None]), st.one_of(st.none(), st.integers(-3, 3)))), max_size=5),
    st.booleans())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(steps=st.lists(step, min_size=2, max_size=4))
def test_aggregates_follow_any_changes(spark, tmp_path_factory, steps):
    folder = tmp_path_factory.mktemp("m")
    table = KeyedTable(spark, f"{folder}/t", SCHEMA, KEY, 2)
    groups = MaintainedAggregate(table, f"{folder}/g", ["g"], MEASURES, buckets=2)
    model = {}
    for n, (changes, fold) in enumerate(steps, 1):
        upserts = {k: v for k, v in changes.items() if v}
        merge(table, n, [(*k, *v) for k, v in upserts.items()], [k for k, v in changes.items() if not v])
        model = {k: v for k, v in {**model, **changes}.items() if v}
        assert state_of(table) == model
        if fold:
            table.fold()
            groups.groups.fold()
        groups.refresh(at(n))
        assert not groups.refresh(at(n))  # a replay changes nothing
        assert rows(groups.read()) == rows(batch_query(table))


def test_refresh_reads_only_changed_groups(spark, table, tmp_path):
    groups = MaintainedAggregate(table, str(tmp_path / "g"), ["g"], MEASURES, buckets=8)
    merge(table, 1, [("x", i, f"g{i % 20}", i) for i in range(200)])
    groups.refresh(at(1))
    groups.groups.fold()
    merge(table, 2, [("x", 3, "g3", 4)])  # g3 loses no extremum: 3 was least, now 4 is
    merge(table, 3, [("x", 43, "g3", 50)])
    touched = groups.changes(1, 3)
    assert touched.count() == 1
    assert "EqualTo(_hash," in plan(groups.groups.lookup(touched.select(HASH, "g")))
    groups.refresh(at(3))
    assert groups.groups.changes(1).count() == 1
    assert rows(groups.read()) == rows(batch_query(table))


def test_extremes_are_computed_again_only_when_they_leave(table, tmp_path, monkeypatch):
    groups = MaintainedAggregate(table, str(tmp_path / "g"), ["g"], {"most": Measure("max", "v")}, buckets=2)
    merge(table, 1, [("x", i, "p", i) for i in range(5)])
    groups.refresh(at(1))
    reads = []
    real = KeyedTable.state
    monkeypatch.setattr(KeyedTable, "state", lambda self: reads.append(self) or real(self))
    for n, (changed, deleted, again) in enumerate([
            ([("x", 0, "p", 3)], [], False), ([("x", 9, "p", 9)], [("x", 4)], False), ([], [("x", 9)], True)], 2):
        reads.clear()
        merge(table, n, changed, deleted)
        groups.refresh(at(n))
        assert (table in reads) == again
    assert groups.read().first()["most"] == 3


def test_floating_point_sums_are_refused(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("x", T.DoubleType())])
    table = KeyedTable(spark, str(tmp_path / "t"), schema, ["a"], 2)
    with pytest.raises(ValueError):
        MaintainedAggregate(table, str(tmp_path / "g"), ["a"], {"s": Measure("sum", "x")})
