"""Merge log, past states, compaction and change feeds."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from martlet.operators import history

KEY = ["k"]
SCHEMA = "k string, v int, w string"


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def log(spark):
    def batch(data, number, op="U"):
        return history.log_rows(table(spark, data), number, at(f"2026-01-0{number} 00:00:00"), op)

    return (
        batch([("a", 1, "x"), ("b", 1, "x"), ("c", 1, None)], 1)
        .unionByName(batch([("a", 2, "y"), ("d", 2, "y")], 2))
        .unionByName(batch([("b", 1, "x"), ("c", 1, None)], 3, "D"))
        .unionByName(batch([("c", 4, "z")], 4))
    )


def state(df):
    return [(r.k, r.v, str(r.inserted_at)[:10]) for r in df.orderBy("k").collect()]


def test_states(log):
    assert state(history.current_state(log, KEY)) == [
        ("a", 2, "2026-01-01"), ("c", 4, "2026-01-04"), ("d", 2, "2026-01-02")]
    second = [("a", 2, "2026-01-01"), ("b", 1, "2026-01-01"), ("c", 1, "2026-01-01"),
              ("d", 2, "2026-01-02")]
    assert state(history.as_of(log, KEY, at("2026-01-02 00:00:00"))) == second
    assert state(history.as_of(log, KEY, at("2026-01-01 23:59:59"))) == [
        ("a", 1, "2026-01-01"), ("b", 1, "2026-01-01"), ("c", 1, "2026-01-01")]
    assert state(history.as_of_offset(log, KEY, at("2026-01-02 00:10:00"), 600)) == second
    assert state(history.before_batch(log, KEY, 3)) == second
    assert history.before_batch(log, KEY, 1).count() == 0


def test_state_shuffles_the_log_once(spark, log):
    """However many keys are deleted: rows were joined to these and then shuffled again by key."""
    spark.conf.set("spark.martlet.broadcastRows", "0")
    try:
        for tasks in (None, 3):
            now = history.current_state(log, KEY, tasks)
            plan = now._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1 and "Join" not in plan and plan.count("Sort [") == 1
            assert state(now) == [("a", 2, "2026-01-01"), ("c", 4, "2026-01-04"), ("d", 2, "2026-01-02")]
    finally:
        spark.conf.unset("spark.martlet.broadcastRows")


def test_many_batches_in_one_write(spark, tmp_path):
    """More batches in a task than it writes at a time, and one that is replaced."""
    many = spark.range(0, 200, 1, 2).select(
        F.col("id").cast("string").alias("k"), F.col("id").cast("int").alias("v"), F.lit("x").alias("w"))
    log = history.log_rows(many, F.col("v") % 40, at("2026-01-01"))
    path = str(tmp_path / "log")
    history.append_batch(log, path)
    history.append_batch(log.where("_batch_id = 7"), path)
    assert rows(history.read_log(spark, path).select(*log.columns)) == rows(log)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


@pytest.mark.parametrize("day", [1, 2, 3, 4])
def test_compaction_keeps_later_states(log, day):
    folded = history.compact(log, KEY, at(f"2026-01-0{day} 12:00:00"))
    assert folded.columns == log.columns
    for later in range(day, 5):
        moment = at(f"2026-01-0{later} 12:00:00")
        assert rows(history.as_of(folded, KEY, moment)) == rows(history.as_of(log, KEY, moment))
    again = history.compact(folded, KEY, at("2026-01-09 00:00:00"))
    assert rows(history.current_state(again, KEY)) == rows(history.current_state(log, KEY))


def test_replayed_batch_replaces_itself(spark, log, tmp_path):
    path = str(tmp_path / "log")
    history.append_batch(log, path)
    history.append_batch(log.where("_batch_id = 2"), path)
    stored = history.read_log(spark, path)
    assert stored.count() == log.count()
    assert rows(history.current_state(stored.select(*log.columns), KEY)) == rows(
        history.current_state(log, KEY))


def test_update_uses_old_values_and_delete(spark, log):
    now = history.current_state(log, KEY)
    changed = history.update_rows(now, F.col("k") == "a", {"v": F.col("v") + 10, "w": F.col("v").cast("string")})
    assert rows(changed) == [("a", 12, "2")]
    gone = history.delete_rows(now, F.col("v") == 4)
    after = log.unionByName(history.log_rows(changed, 5, at("2026-01-05"))).unionByName(
        history.log_rows(gone, 5, at("2026-01-05"), "D"))
    assert state(history.current_state(after, KEY)) == [
        ("a", 12, "2026-01-01"), ("d", 2, "2026-01-02")]


def test_insert_only(spark):
    target, source = table(spark, [("a", 1, "x")]), table(spark, [("a", 9, "n"), ("b", 9, "n")])
    assert rows(history.only_new(source, target, KEY)) == [("b", 9, "n")]


def test_feed_actions(spark):
    old = table(spark, [("a", 1, None), ("b", 1, "x"), ("c", None, "x")])
    new = table(spark, [("a", 1, None), ("b", 2, "x"), ("d", 1, "x")])
    feed = history.change_feed(old, new, KEY)
    assert rows(feed) == sorted([
        ("b", 1, "x", "DELETE", True), ("b", 2, "x", "INSERT", True),
        ("c", None, "x", "DELETE", False), ("d", 1, "x", "INSERT", False)], key=repr)
    assert rows(history.inserts(feed).select("k")) == [("b",), ("d",)]
    assert not history.has_data(history.change_feed(old, old, KEY))


def test_null_keys(spark):
    """NULL is a key value: such rows are deleted, updated and left alone like any other."""
    base = table(spark, [(None, 1, "x"), ("a", 1, "x")])
    log = history.log_rows(base, 1, at("2026-01-01"))
    gone = log.unionByName(history.log_rows(base.where("k IS NULL"), 2, at("2026-01-02"), "D"))
    assert [tuple(r)[:2] for r in history.current_state(gone, KEY).collect()] == [("a", 1)]
    assert not history.has_data(history.change_feed(base, base, KEY))
    assert history.only_new(base, base, KEY).count() == 0
    changed = table(spark, [(None, 2, "x"), ("a", 1, "x")])
    feed = history.change_feed(base, changed, KEY)
    assert rows(feed) == sorted([(None, 1, "x", "DELETE", True), (None, 2, "x", "INSERT", True)], key=repr)
    assert rows(history.apply_feed(base, feed, KEY)) == rows(changed)


keyed = st.dictionaries(
    st.sampled_from([*"abcde", None]),
    st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from("xy"))),
    max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=keyed, new=keyed)
def test_feed_turns_old_into_new_and_merge_is_idempotent(spark, old, new):
    before = table(spark, [(k, *v) for k, v in old.items()])
    after = table(spark, [(k, *v) for k, v in new.items()])
    feed = history.change_feed(before, after, KEY)
    assert rows(history.apply_feed(before, feed, KEY)) == rows(after)

    once = history.log_rows(before, 1, at("2026-01-01")).unionByName(
        history.log_rows(after, 2, at("2026-01-02")))
    twice = once.unionByName(history.log_rows(after, 3, at("2026-01-03")))
    merged = {**old, **new}
    assert rows(history.current_state(once, KEY).drop("inserted_at")) == sorted(
        [(k, *v) for k, v in merged.items()], key=repr)
    assert rows(history.current_state(twice, KEY)) == rows(history.current_state(once, KEY))
