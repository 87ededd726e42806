"""Layers that every query of the mart is built on: what they shuffle, and that they lose nothing by it."""

from __future__ import annotations

import os
from datetime import datetime

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from martlet.operators.ordered import latest_of_copies, latest_per_key
from martlet.plans import mart
from martlet.plans.workspace import Workspace
from martlet.sources import fixtures

from conftest import rows

DAY = datetime(1997, 5, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def tables(spark, lines):
    orders = spark.createDataFrame(
        [(n, 7, "F", DAY) for n in (1, 2, 3, 4, None)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz")
    lineitem = spark.createDataFrame(
        [(k, p, 1, n, q, 10.0, 0.0, 0.0, "N", "O", day) for n, (k, p, q, day) in enumerate(lines)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    part = spark.createDataFrame(
        [(1, "bolt", "SMALL", 2.5), (2, "nut", "LARGE", 1.5), (2, "nut again", "LARGE", 1.5)],
        "p_partkey long, p_name string, p_type string, p_retailprice double")
    return orders, lineitem, part


def test_documents_of_small_and_large_orders(spark):
    """Order 1 is small, 2 has no lines, 3 only a line without its product, 4 lines without a date; parts may repeat."""
    orders, lineitem, part = tables(spark, [
        (1, 1, 5.0, DAY), (1, 2, 6.0, DAY), (3, 9, 1.0, DAY), (4, 1, 2.0, None), (None, 1, 1.0, DAY)])
    whole = fixtures.event_documents(orders, lineitem, part)
    assert "Window" not in plan(whole)  # before, every line was numbered in a window first
    spark.conf.set("spark.martlet.broadcastRows", "0")
    try:
        shuffled = rows(fixtures.event_documents(orders, lineitem, part))
    finally:
        spark.conf.unset("spark.martlet.broadcastRows")
    assert rows(whole) == shuffled
    found = mart.stg_event_items(mart.raw_events(whole))
    assert rows(found.select("event_id", "sku", "product_name", "qty", "line_no")) == rows(spark.createDataFrame(
        [("1", "1", "bolt", 5, 0), ("1", "2", "nut", 6, 1), ("1", "2", "nut again", 6, 2), ("4", "1", "bolt", 2, 0)],
        "event_id string, sku string, product_name string, qty long, line_no long").withColumn("line_no", F.col("line_no") + 1))
    assert rows(whole.groupBy(F.get_json_object("line", "$.event_id").alias("id")).count()) == rows(spark.createDataFrame(
        [("1", 1), ("2", 1), ("4", 2), (None, 1)], "id string, count long"))


def test_both_ways_give_the_same_documents(spark):
    orders, lineitem, part = tables(spark, [(n % 4 + 1, n // 4 % 2 + 1, float(n), DAY) for n in range(40)])
    want = rows(fixtures.event_documents(orders, lineitem, part))
    spark.conf.set("spark.martlet.documentItems", "11")
    try:  # 10 lines are 15 items: divided inside the row, and by numbering
        inside = rows(fixtures.event_documents(orders, lineitem, part))
        spark.conf.set("spark.martlet.documentItems", "9")
        assert len(inside) > len(want)
        numbered = fixtures.event_documents(orders, lineitem, part)
        assert "Window" in plan(numbered)
        items = lambda docs: rows(mart.stg_event_items(mart.raw_events(docs)).drop("loaded_at", "line_no"))  # lines that tie: in any order
        assert items(numbered) == items(spark.createDataFrame(want, "line string, src_filename string, loaded_at timestamp_ntz"))
    finally:
        spark.conf.unset("spark.martlet.documentItems")


def test_only_copied_keys_are_compared(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", 1), ("a", 1, "y", 2), ("a", None, "z", 1), ("a", None, "z", 1), (None, 1, "u", 1), ("b", 2, "v", 3)],
        "k string, n int, v string, at int")
    want = rows(latest_per_key(df, ["k", "n"], ["at"]))
    found = latest_of_copies(df, ["k", "n"], ["at"])
    assert rows(found) == want and len(want) == 4
    assert "LeftAnti" in plan(found)  # rows of a key without copies meet no aggregate
    many = latest_of_copies(df, ["k", "n"], ["at"], max_copied=1)
    assert rows(many) == want and "LeftAnti" not in plan(many)


def test_header_is_read_before_the_items_are_exploded(spark):
    raw = spark.createDataFrame([('{"event_id":"1","items":[{"sku":"a"},{"sku":"b"}]}', "f", DAY)],
                                "line string, src_filename string, loaded_at timestamp_ntz")
    text = plan(mart.stg_event_items(mart.raw_events(raw)))
    assert "$.event_id" in text[text.index("Generate"):]


def test_the_mart_does_not_store_documents_and_variants(spark, tmp_path):
    stamp = F.lit("1998-01-02").cast("timestamp_ntz")
    spark.range(6).select(
        F.col("id").alias("o_orderkey"), F.lit(1).cast("bigint").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        stamp.alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    number = F.lit(1.0)
    spark.range(12).select(
        (F.col("id") % 6).alias("l_orderkey"), (F.col("id") % 4).alias("l_partkey"), F.col("id").alias("l_suppkey"),
        F.col("id").cast("int").alias("l_linenumber"), number.alias("l_quantity"), number.alias("l_extendedprice"),
        number.alias("l_discount"), number.alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        stamp.alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(4).select(
        F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("t").alias("p_type"),
        F.lit(2.5).alias("p_retailprice")).write.parquet(f"{tmp_path}/part.parquet")
    ws = Workspace(spark, str(tmp_path))
    fact = rows(ws.fact)
    assert len(fact) == 12
    assert not os.path.exists(_local(ws.location("documents"))) and not os.path.exists(_local(ws.location("raw_events")))
    assert ws.raw.count() == 6 and os.path.exists(_local(ws.location("raw_events")))
    again = mart.merge_stored(mart.stg_event_items(ws.raw)).select(*mart.FACT_COLUMNS)
    assert rows(again) == fact  # the same from the stored variants


def test_a_table_may_have_several_row_groups_in_a_file(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path))
    frame = ws.table("grouped", lambda: spark.range(0, 200_000, 1, 1).select(F.md5(F.col("id").cast("string")).alias("m")),
                     **{"parquet.block.size": str(1 << 20)})
    (file,) = [f.removeprefix("file://").removeprefix("file:") for f in frame.inputFiles()]
    assert pq.ParquetFile(file).num_row_groups > 1 and frame.count() == 200_000


def _local(folder):
    return folder.removeprefix("file://").removeprefix("file:")
