"""Known totals of small literal data."""

import json

from pyspark.sql import functions as F

import golden
from martlet.operators.joins import star_totals
from martlet.plans import mart


def totals(df, key, value="line_amount"):
    return {r[0]: int(r[1]) for r in df.groupBy(key).agg(F.sum(value)).collect()}


def normalised(spark):
    orders = spark.createDataFrame(golden.ORDERS, "order_id string, user_id string, order_date string")
    items = spark.createDataFrame(
        golden.order_items(), "order_id string, sku string, qty bigint, price int")
    return orders.withColumn("order_date", F.to_date("order_date")), items.withColumn(
        "price", F.col("price").cast("decimal(10,2)"))


def test_normalised_orders_to_star(spark):
    fact = mart.fact_order_lines(*normalised(spark))
    assert fact.count() == 40
    assert int(fact.agg(F.sum("line_amount")).first()[0]) == 224750
    products = spark.createDataFrame(golden.PRODUCTS, "sku string, product_name string, category string")
    users = spark.createDataFrame(golden.USERS, "user_id string, user_name string, prefecture string")
    expected = {"Sports": 67700, "Home": 60700, "Electronics": 53800, "Fashion": 29800, "Food": 12750}
    by_prefecture = {"東京": 85200, "福岡": 40600, "大阪": 38750, "愛知": 20900, "神奈川": 17000,
                     "北海道": 11300, "兵庫": 5700, "京都": 5300}
    for limit in (1000, 0):  # broadcast, and the shuffled path with sums before the join
        by = star_totals(fact, [(products, "sku")], ["category"], {"s": "line_amount"}, limit)
        assert {r[0]: int(r[1]) for r in by.collect()} == expected
        by = star_totals(fact, [(users, "user_id"), (products, "sku")], ["prefecture"],
                         {"s": "line_amount"}, limit)
        assert {r[0]: int(r[1]) for r in by.collect()} == by_prefecture


def raw_events(spark):
    lines = spark.createDataFrame([(json.dumps(d),) for d in golden.documents()], "line string")
    return mart.raw_events(lines.select(
        "line", F.lit("events.json").alias("src_filename"),
        F.lit("2026-02-08 00:00:00").cast("timestamp_ntz").alias("loaded_at")))


def test_eight_events_to_items(spark):
    raw = raw_events(spark)
    headers = mart.stg_events(raw)
    assert headers.count() == 8
    assert headers.where(F.col("review_text").isNotNull()).count() == 5
    first = headers.where("event_id = 'e001'").first()
    assert (first.device_os, first.app_version, str(first.event_time)) == (
        "iOS", "2.0.0", "2026-02-01 09:00:00")
    items = mart.stg_event_items(raw)
    assert items.count() == 12
    assert totals(items, "category") == {
        "Home": 22500, "Sports": 21800, "Electronics": 15200, "Food": 7450, "Fashion": 3000}
    assert totals(items, "user_id") == {
        "u003": 30700, "u001": 18600, "u005": 12000, "u002": 5650, "u004": 3000}


def test_wall_clock_is_kept_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        times = mart.stg_events(raw_events(spark)).select(F.col("event_time").cast("string"))
        assert "2026-02-01 09:00:00" in {r[0] for r in times.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_device_as_text_and_items_without_names(spark):
    line = json.dumps({"event_id": "x", "user_id": "u", "device": "mobile",
                       "event_time": "2026-02-01T09:00:00Z",
                       "items": [{"sku": "S", "qty": 1.5, "price": 9.555}]})
    raw = mart.raw_events(spark.createDataFrame([(line, "f", None)],
                                                "line string, src_filename string, loaded_at timestamp_ntz"))
    header = mart.stg_events(raw).first()
    assert header.device_os is None and header.event_type is None
    item = mart.stg_event_items(raw).first()
    assert (item.product_name, item.category, item.qty, str(item.price)) == (None, None, 2, "9.56")
    assert mart.dyn_stg_events(raw).first().device == "mobile"


def test_empty_and_missing_arrays_vanish(spark):
    lines = [json.dumps({"event_id": "a", "items": []}), json.dumps({"event_id": "b"})]
    raw = mart.raw_events(spark.createDataFrame(
        [(x, "f", None) for x in lines], "line string, src_filename string, loaded_at timestamp_ntz"))
    assert mart.stg_event_items(raw).count() == 0
    assert mart.stg_events(raw).count() == 2


def test_latest_copy_wins(spark):
    raw = raw_events(spark)
    again = raw.withColumns({
        "loaded_at": F.timestamp_add("DAY", F.lit(1), F.col("loaded_at")),
        "src_filename": F.lit("later.json")})
    both = raw.unionByName(again)
    assert {r.src_filename for r in mart.stg_events_latest(both).collect()} == {"later.json"}
    fact = mart.fact_purchase_events(mart.stg_event_items(both))
    assert fact.count() == 12 and int(fact.agg(F.sum("line_amount")).first()[0]) == 69950
