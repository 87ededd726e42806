"""Incremental loading, exactly-once merging, forced reloads and the chained job."""

import json
import os
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import golden
from conftest import rows
from martlet.operators import history
from martlet.operators.keyed import KeyedTable
from martlet.operators.maintained import MaintainedAggregate, Measure
from martlet.plans import mart
from martlet.sources import ingest
from martlet.streaming import incremental, job

FACT = list(mart.FACT_COLUMNS)


def land(folder, name, documents, extra=()):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([*map(json.dumps, documents), *extra]) + "\n")


@pytest.fixture
def paths(tmp_path):
    return job.Paths(str(tmp_path / "root"), str(tmp_path / "landing"))


def load(spark, paths, **options):
    incremental.start_load(spark, paths.landing, paths.raw, paths.checkpoint("load"), **options
                        ).awaitTermination()
    return spark.read.parquet(paths.raw).count()


def batch_fact(spark, paths):
    raw = ingest.read_json_events(spark, paths.landing)
    return mart.fact_purchase_events(mart.stg_event_items(raw))


def test_only_new_files_are_loaded(spark, paths, tmp_path):
    documents = golden.documents()
    land(tmp_path / "landing", "a.json", documents[:5])
    assert load(spark, paths) == 5
    assert load(spark, paths) == 5
    land(tmp_path / "landing", "b.json", documents[5:])
    assert load(spark, paths) == 8
    raw = spark.read.parquet(paths.raw)
    assert rows(ingest.rows_per_file(raw)) == [("a.json", 5), ("b.json", 3)]


def test_job_equals_one_batch_run(spark, paths, tmp_path):
    documents = golden.documents()
    land(tmp_path / "landing", "a.json", documents[:3])
    assert job.run(spark, paths) == 5
    land(tmp_path / "landing", "b.json", documents[2:], extra=['{"event_id": "cut'])
    assert job.run(spark, paths) == 12
    assert job.run(spark, paths) == 12
    found = job.fact(spark, paths).select(*FACT)
    assert rows(found) == rows(batch_fact(spark, paths).select(*FACT))
    assert int(found.agg(F.sum("line_amount")).first()[0]) == 69950


def test_target_schema_is_a_parameter(spark, paths, tmp_path):
    land(tmp_path / "landing", "a.json", golden.documents())
    assert job.run(spark, paths, "mart") == job.run(spark, paths, "mart_test") == 12


def test_empty_fact_stops_the_job(spark, paths, tmp_path):
    land(tmp_path / "landing", "a.json", [{"event_id": "x", "items": []}])
    with pytest.raises(RuntimeError, match="empty"):
        job.run(spark, paths)


def test_failed_merge_is_delivered_again(spark, paths, tmp_path):
    land(tmp_path / "landing", "a.json", golden.documents())
    load(spark, paths)
    log_path, tries = paths.fact_log("mart"), []

    def write_then_die(batch, path, batch_id, commit_ts):
        incremental.merge_purchase_events(batch, path, batch_id, commit_ts)
        tries.append(batch_id)
        raise RuntimeError("lost between write and commit")

    with pytest.raises(Exception, match="lost between write and commit"):
        incremental.start_merge(spark, paths.raw, log_path, paths.checkpoint("merge"),
                             merge=write_then_die).awaitTermination()
    assert spark.read.parquet(log_path).count() == 12
    incremental.start_merge(spark, paths.raw, log_path, paths.checkpoint("merge")).awaitTermination()
    log = spark.read.parquet(log_path)
    assert tries == [0] and log.count() == 12 and log.select("_batch_id").distinct().count() == 1
    # The position has advanced: nothing is left to deliver.
    incremental.start_merge(spark, paths.raw, log_path, paths.checkpoint("merge")).awaitTermination()
    assert spark.read.parquet(log_path).count() == 12


def test_forced_reload_leaves_the_fact_unchanged(spark, paths, tmp_path):
    land(tmp_path / "landing", "a.json", golden.documents())
    job.run(spark, paths)
    before = job.fact(spark, paths)
    expected = rows(before)
    incremental.reload_files(spark, paths.landing, paths.raw)
    incremental.reload_files(spark, paths.landing, paths.raw)
    assert spark.read.parquet(paths.raw).count() == 24
    assert job.run(spark, paths) == 12
    # Even the insertion time stays: the reloaded rows update existing keys.
    assert rows(job.fact(spark, paths)) == expected


def test_skip_file_in_the_stream(spark, paths, tmp_path):
    documents = golden.documents()
    land(tmp_path / "landing", "bad.json", documents[:4], extra=["{oops"])
    land(tmp_path / "landing", "good.json", documents[4:])
    assert load(spark, paths, on_error="skip_file", files_per_batch=1) == 4


def test_dynamic_table_equals_batch(spark, paths, tmp_path):
    documents = golden.documents()
    table, checkpoint = f"{paths.root}/dyn", paths.checkpoint("dyn")
    for name, part in (("a.json", documents[:6]), ("b.json", documents[6:])):
        land(tmp_path / "landing", name, part)
        load(spark, paths)
        incremental.start_dynamic_table(
            spark, paths.raw, table, checkpoint, interval=None).awaitTermination()
    raw = spark.read.parquet(paths.raw).drop("_load_id")
    assert rows(spark.read.parquet(table)) == rows(mart.dyn_stg_events(raw))


def test_dynamic_table_keeps_running(spark, paths, tmp_path):
    land(tmp_path / "landing", "a.json", golden.documents())
    load(spark, paths)
    running = incremental.start_dynamic_table(
        spark, paths.raw, f"{paths.root}/dyn", paths.checkpoint("dyn"), interval="1 minute")
    try:
        running.processAllAvailable()
        assert running.isActive
        assert spark.read.parquet(f"{paths.root}/dyn").count() == 8
    finally:
        running.stop()


def test_has_data(spark):
    feed = spark.range(3)
    assert history.has_data(feed) and not history.has_data(feed.where("id > 5"))


def test_files_older_than_the_newest_are_loaded(spark, paths, tmp_path):
    documents = golden.documents()
    land(tmp_path / "landing", "new.json", documents[:4])
    assert load(spark, paths) == 4
    land(tmp_path / "landing", "late.json", documents[4:])
    weeks_ago = (tmp_path / "landing" / "new.json").stat().st_mtime - 40 * 86400
    os.utime(tmp_path / "landing" / "late.json", (weeks_ago, weeks_ago))
    assert load(spark, paths) == 8


def test_backlog_of_months_one_file_at_a_time(spark, paths, tmp_path):
    for n, document in enumerate(golden.documents()):
        land(tmp_path / "landing", f"{n}.json", [document])
        when = 1_700_000_000 + (n * 5 % 8) * 30 * 86400
        os.utime(tmp_path / "landing" / f"{n}.json", (when, when))
    assert load(spark, paths, files_per_batch=1) == 8


def test_arrival_order_does_not_pick_the_winner(spark):
    copies = [("e", "s", 1, "t", "f", 1), ("e", "s", 2, "t", "f", 1), ("e", None, 5, "t", "f", 1), ("e", None, 4, "t", "f", 1)]
    names = ["event_id", "sku", "qty", "loaded_at", "src_filename", "line_no"]
    for order in (copies, copies[::-1]):
        for parts in (1, 4):
            items = spark.createDataFrame(order, names).repartition(parts)
            found = rows(mart.merge_source(items).select("sku", "qty"))
            assert found == [("s", 2), (None, 5)] or found == [(None, 5), ("s", 2)]


def test_replays_change_nothing(spark, paths, tmp_path):
    """A load and a merge whose commits are lost are delivered again, and nothing downstream sees it."""
    land(tmp_path / "landing", "a.json", golden.documents())
    load(spark, paths)
    dyn = lambda: incremental.start_dynamic_table(
        spark, paths.raw, f"{paths.root}/dyn", paths.checkpoint("dyn"), interval=None).awaitTermination()
    log = paths.fact_log("mart")
    merge = lambda: incremental.start_merge(spark, paths.raw, log, paths.checkpoint("merge")).awaitTermination()
    dyn(), merge()
    raw, fact = rows(spark.read.parquet(paths.raw).select("loaded_at")), rows(job.fact(spark, paths))
    for step in ("load", "merge"):
        for commit in (pathlib.Path(paths.checkpoint(step)) / "commits").glob("*0*"):
            commit.unlink()
    load(spark, paths)
    dyn(), merge()
    assert rows(spark.read.parquet(paths.raw).select("loaded_at")) == raw
    assert rows(job.fact(spark, paths)) == fact
    assert spark.read.parquet(f"{paths.root}/dyn").count() == 8


def test_forced_reload_into_an_empty_table(spark, paths, tmp_path):
    land(tmp_path / "landing", "a.json", golden.documents())
    incremental.reload_files(spark, paths.landing, paths.raw)
    assert spark.read.parquet(paths.raw).count() == 8


def test_folding_keeps_the_fact_and_survives_a_lost_fold(spark, paths, tmp_path):
    log = paths.fact_log("mart")
    for n, document in enumerate(golden.documents()):
        land(tmp_path / "landing", f"{n}.json", [document, golden.documents()[0]])
        job.run(spark, paths, fold_after=3)
    assert history.newest_base(spark, log) is not None and len(history.open_batches(spark, log)) < 3
    expected = rows(batch_fact(spark, paths).select(*FACT))
    assert rows(job.fact(spark, paths).select(*FACT)) == expected
    whole = history.current_state(history.read_log(spark, log, job.FACT_LOG_SCHEMA), mart.FACT_KEY)
    assert rows(job.fact(spark, paths)) == rows(whole)
    (pathlib.Path(f"{log}_bases") / "aside-dead").mkdir()
    assert history.fold(spark, log, mart.FACT_KEY, job.FACT_LOG_SCHEMA) is not None
    assert history.fold(spark, log, mart.FACT_KEY, job.FACT_LOG_SCHEMA) is None
    assert rows(job.fact(spark, paths)) == rows(whole)
    gone = history.expire(spark, log)
    assert len(gone) == 8 and rows(job.fact(spark, paths).select(*FACT)) == expected
    assert job.run(spark, paths, fold_after=3) == 12


def test_followed_aggregates_keep_up(spark, paths, tmp_path):
    """Sales by category stay those of the fact, load by load, also after a batch that did not reach them."""
    fact = mart.fact_purchase_events(mart.stg_event_items(ingest.to_raw(spark.createDataFrame(
        [("{}", "f", "p")], "line string, src_filename string, src_path string")).drop("src_path").withColumn(
            "loaded_at", F.localtimestamp())))
    table = KeyedTable(spark, f"{paths.root}/fact", T.StructType([fact.schema[c] for c in FACT]), mart.FACT_KEY, 4)
    sales = MaintainedAggregate(table, f"{paths.root}/sales", ["category"], {
        "lines": Measure("count"), "amount": Measure("sum", "line_amount"), "orders": Measure("distinct", "event_id")}, buckets=2)

    def step(*followers):
        load(spark, paths)
        incremental.start_followed_merge(
            spark, paths.raw, table, followers, paths.checkpoint("followed"), interval=None).awaitTermination()

    def same():
        want = table.state().groupBy("category").agg(
            F.count(F.lit(1)).alias("lines"), F.sum("line_amount").alias("amount"), F.count_distinct("event_id").alias("orders"))
        assert rows(sales.read()) == rows(want) and rows(want)

    documents = golden.documents()
    land(tmp_path / "landing", "a.json", documents[:4])
    step(sales)
    same()
    land(tmp_path / "landing", "b.json", documents[3:6])
    step()  # merged, but the aggregates were not reached
    land(tmp_path / "landing", "c.json", documents[5:])
    step(sales)
    same()
    assert rows(table.state().select(*FACT).drop("src_filename")) == rows(batch_fact(spark, paths).select(*FACT).drop("src_filename"))
