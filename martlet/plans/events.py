"""Queries on sources, JSON documents and the staging models."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlet.operators.ordered import asc, latest_per_key
from martlet.operators.variant import (
    MONEY, flatten, flatten_with_meta, header_columns, item_columns, nest, path,
)
from martlet.plans import mart
from martlet.plans.oracle import EVENTS, LINES, double, on_events, text, with_ctes
from martlet.plans.registry import query
from martlet.plans.relational import normalised_orders
from martlet.sizing import lookup_join
from martlet.sources import generator, ingest, tables


def on_lines(select: str) -> str:
    return with_ctes(LINES, select=select)


def _event_type(raw="raw"):
    return path(raw, "event_type")


def _landing(ws) -> str:
    """A folder of text files: every event, and a cut-off transmission of every view event."""
    documents = ws.documents
    views = mart.headers(documents.withColumn("raw", F.parse_json("line"))).where(_event_type() == "view")
    cut_off = views.select(
        F.substring("line", 1, 40).alias("line"))
    where = ws.location("landing")
    ws.once("landing", lambda: documents.select("line").unionByName(cut_off).write.mode(
        "overwrite").text(where))
    return where


HEADER = ("event_id, user_id, event_type, device_os, app_version, CAST(NULL AS VARCHAR) AS review_text, "
          + text("event_time"))


@query("src_json_events", on_events(f"SELECT {HEADER}, true AS has_file FROM events_flat"))
def src_json_events(ws):
    raw = mart.headers(ingest.read_json_events(ws.spark, _landing(ws), "continue"))
    return raw.select(*header_columns(), F.col("src_filename").isNotNull().alias("has_file"))


@query("copy_quarantine", on_events("""
SELECT count(*) AS rejected_lines, CAST(max(40) AS INTEGER) AS longest
FROM events_flat WHERE event_type = 'view'"""))
def copy_quarantine(ws):
    bad = ingest.rejected(ingest.read_lines(ws.spark, _landing(ws)))
    return bad.agg(F.count(F.lit(1)).alias("rejected_lines"),
                   F.max(F.length("line")).alias("longest"))


@query("copy_skip_file", on_events("""
SELECT event_id, user_id, src_filename FROM events_flat
WHERE src_filename IS NULL AND event_type = 'purchase'
   OR src_filename IS NOT NULL AND src_filename <> 'part-2.json'"""))
def copy_skip_file(ws):
    # Transmissions of view events broke off in one file and in the lines without a file.
    kind = _event_type(F.parse_json("line"))
    broken = (kind == "view") & (
        F.col("src_filename").isNull() | (F.col("src_filename") == "part-2.json"))
    lines = ws.documents.withColumn(
        "line", F.when(broken, F.substring("line", 1, 40)).otherwise(F.col("line")))
    raw = mart.headers(ingest.to_raw(lines, "skip_file", "src_filename"))
    return raw.select(path("raw", "event_id").alias("event_id"),
                      path("raw", "user_id").alias("user_id"), "src_filename")


@query("src_values", on_events("""
SELECT e.device_os, d.vendor, count(*) AS event_count
FROM events_flat e
JOIN (VALUES ('iOS', 'fruit'), ('Android', 'robot'), ('PC', 'desk')) AS d(os, vendor)
  ON d.os = e.device_os
GROUP BY e.device_os, d.vendor"""))
def src_values(ws):
    # Three literal rows of JSON text, read like any other document.
    literal = ws.spark.sql("""
        SELECT parse_json(v) AS raw FROM VALUES
          ('{"os": "iOS", "vendor": "fruit"}'),
          ('{"os": "Android", "vendor": "robot"}'),
          ('{"os": "PC", "vendor": "desk"}') AS t(v)""")
    devices = literal.select(path("raw", "os").alias("device_os"),
                             path("raw", "vendor").alias("vendor"))
    return lookup_join(ws.events.select("device_os"), devices, "device_os").groupBy(
        "device_os", "vendor").agg(F.count(F.lit(1)).alias("event_count"))


@query("insert_select_lines", """
SELECT o_orderkey AS order_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
       o_custkey AS user_id, l_partkey AS sku, CAST(l_quantity AS BIGINT) AS qty,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
       CAST(CAST(CAST(l_quantity AS BIGINT) * CAST(l_extendedprice AS DECIMAL(10,2))
            AS DECIMAL(12,2)) AS DOUBLE) AS line_amount
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def insert_select_lines(ws):
    where = ws.location("inserted_order_lines")

    def build():
        name = f"order_lines_{ws.digest}"
        tables.drop_table(ws.spark, name)
        tables.create_table(
            ws.spark, name,
            "order_id BIGINT, order_date DATE, user_id BIGINT, sku BIGINT, qty BIGINT, "
            "price DECIMAL(10,2), line_amount DECIMAL(12,2)", where)
        tables.insert_select(mart.fact_order_lines(*normalised_orders(ws)), name)
        tables.drop_table(ws.spark, name)  # the rows stay at their location

    ws.once("inserted_order_lines", build)
    return ws.spark.read.parquet(where)


def _drawn(low: int, high: int, use: str) -> str:
    digits = f"substr(md5(CAST(o_orderkey AS VARCHAR) || '|42|{use}'), 1, 13)"
    return f"({low} + CAST('0x' || {digits} AS BIGINT) % {high - low + 1})"


@query("gen_events", f"""
WITH drawn AS (
  SELECT o_orderkey, {_drawn(1, 100, 'sku')} AS s, {_drawn(0, 7776000, 'time')} AS t,
         {_drawn(1, 30, 'user')} AS u, {_drawn(1, 3, 'qty')} AS qty, {_drawn(100, 9999, 'price')} AS price
  FROM orders)
SELECT 'gen_' || o_orderkey AS event_id, 'u' || lpad(CAST(u AS VARCHAR), 3, '0') AS user_id,
       'purchase' AS event_type, ['iOS', 'Android', 'PC'][o_orderkey % 3 + 1] AS device_os,
       '2.0.0' AS app_version, CAST(NULL AS VARCHAR) AS review_text,
       CAST(TIMESTAMP '2025-12-01' + t * INTERVAL 1 SECOND AS VARCHAR) AS event_time,
       'SKU' || lpad(CAST(s AS VARCHAR), 4, '0') AS sku, 'Product_' || lpad(CAST(s AS VARCHAR), 4, '0') AS product_name,
       ['Sports', 'Food', 'Home', 'Electronics', 'Fashion'][(s - 1) % 5 + 1] AS category, qty,
       CAST(price AS DOUBLE) AS price, CAST(qty * price AS DOUBLE) AS line_amount, 'generated' AS src_filename
FROM drawn""")
def gen_events(ws):
    raw = generator.generate_events(ws.source("orders").select("o_orderkey"), "o_orderkey")
    return flatten(raw, "items").select(
        *header_columns(), *item_columns(), "src_filename")


@query("load_audit", on_events("""
SELECT src_filename, count(*) AS row_count FROM events_flat GROUP BY src_filename"""))
def load_audit(ws):
    return ingest.rows_per_file(mart.headers(ws.raw)).orderBy("src_filename")


@query("json_header", on_events(f"SELECT {HEADER} FROM events_flat"))
def json_header(ws):
    return mart.headers(ws.raw).select(*header_columns())


@query("json_nested", on_events("SELECT event_id, device_os, app_version FROM events_flat"))
def json_nested(ws):
    return mart.headers(ws.raw).select(
        path("raw", "event_id").alias("event_id"), path("raw", "device.os").alias("device_os"),
        path("raw", "device.app_version").alias("app_version"))


DEVICE_TEXT = """CASE WHEN device_os IS NULL THEN 'mobile'
            ELSE '{"app_version":"2.0.0","os":"' || device_os || '"}' END AS device"""


@query("json_object_text", on_events(f"SELECT event_id, {DEVICE_TEXT} FROM events_flat"))
def json_object_text(ws):
    return mart.headers(ws.raw).select(path("raw", "event_id").alias("event_id"),
                         path("raw", "device").alias("device"))


@query("json_text_path", """
SELECT event_type, count(*) AS event_count, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total
FROM events GROUP BY event_type""")
def json_text_path(ws):
    k = path(F.try_parse_json("props"), "k", "bigint")
    return ws.source("events").select("event_type", k.alias("k")).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.sum("k").alias("k_total"))


ITEM = f"event_id, sku, product_name, category, qty, {double('price', 'line_amount')}"


@query("flatten_items", on_lines(f"SELECT {ITEM} FROM lines"))
def flatten_items(ws):
    return flatten(ws.raw, "items").select(path("raw", "event_id").alias("event_id"),
                                           *item_columns())


@query("flatten_meta", on_lines("""
SELECT event_id, CAST(NULL AS VARCHAR) AS key, '[' || CAST(line_no - 1 AS VARCHAR) || ']' AS path,
       CAST(line_no - 1 AS INTEGER) AS index, sku AS value_sku, sku AS this_sku
FROM lines"""))
def flatten_meta(ws):
    # Positions go on over the documents of a large event; THIS is the array of one document.
    raw = ws.raw.withColumns({
        "event_id": path("raw", "event_id"),
        "before": F.coalesce(path("raw", "offset", "bigint"), F.lit(0)),
    })
    flat = flatten_with_meta(raw, "event_id", "items", keep=["before"], offset=F.col("before"))
    here = F.get(F.col("this").cast("array<variant>"), (F.col("index") - F.col("before")).cast("int"))
    return flat.select(
        "event_id", "key", "path", "index", path("value", "sku").alias("value_sku"),
        path(here, "sku").alias("this_sku"))


@query("flatten_object", """
SELECT event_id, 'k' AS key, 'k' AS path, CAST(NULL AS INTEGER) AS index,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS value
FROM events""")
def flatten_object(ws):
    wrapped = ws.source("events").select(
        "event_id", F.to_variant_object(F.struct(F.parse_json("props").alias("props"))).alias("raw"))
    flat = flatten_with_meta(wrapped, "event_id", "props")
    return flat.select("event_id", "key", "path", "index",
                       F.col("value").cast("bigint").alias("value"))


@query("flatten_agg", on_lines("""
SELECT category, product_name, CAST(sum(qty) AS BIGINT) AS total_qty,
       CAST(sum(line_amount) AS DOUBLE) AS sales_amount
FROM lines WHERE event_type = 'purchase' GROUP BY category, product_name"""))
def flatten_agg(ws):
    purchases = ws.raw.where(_event_type() == "purchase")
    return flatten(purchases, "items").select(*item_columns()).groupBy(
        "category", "product_name").agg(
        F.sum("qty").alias("total_qty"), F.sum("line_amount").alias("sales_amount"))


@query("json_filter_explode", on_lines(
    f"SELECT {ITEM} FROM lines WHERE event_type = 'purchase'"))
def json_filter_explode(ws):
    # The filter sits below the generator, so items of other events are never produced.
    purchases = ws.raw.where(_event_type() == "purchase")
    return flatten(purchases, "items").select(path("raw", "event_id").alias("event_id"),
                                              *item_columns())


@query("object_build", on_lines("""
SELECT event_id, sku, line_no,
       '{"sku":"' || sku || '","detail":{"category":"' || category || '","qty":'
         || CAST(qty AS VARCHAR) || '},"tags":["' || event_type || '","line"]}' AS document
FROM lines"""))
def object_build(ws):
    kinds = ws.raw.select(path("raw", "event_type").alias("event_type"), "raw")
    flat = flatten(kinds, "items")
    item = {c: path("value", c) for c in ("sku", "category")}
    built = F.to_json(F.struct(
        item["sku"].alias("sku"),
        F.struct(item["category"].alias("category"), path("value", "qty", "bigint").alias("qty"))
        .alias("detail"),
        F.array("event_type", F.lit("line")).alias("tags")))
    return flat.select(
        path("raw", "event_id").alias("event_id"), item["sku"].alias("sku"),
        path("value", "line_no", "bigint").alias("line_no"), built.alias("document"))


@query("nest_items", on_lines("""
SELECT event_id, row_number() OVER (PARTITION BY event_id ORDER BY sku, line_no) AS line_no,
       '{"line_no":' || CAST(row_number() OVER (PARTITION BY event_id ORDER BY sku, line_no) AS VARCHAR)
         || ',"sku":"' || sku || '","qty":' || CAST(qty AS VARCHAR) || '}' AS item
FROM lines"""))
def nest_items(ws):
    items = ws.event_items.select("event_id", "sku", "qty", F.col("line_no").alias("position"))
    nested = nest(items, ["event_id"], ["sku", "qty"], asc("sku", "position"))
    # Round trip: the documents as JSON text, and their items back as rows, in however many parts.
    documents = nested.select("event_id", F.to_json("items").alias("items"))
    item = F.explode(F.from_json("items", "array<struct<line_no:bigint,sku:string,qty:bigint>>"))
    return documents.select("event_id", item.alias("item")).select(
        "event_id", "item.line_no", F.to_json("item").alias("item"))


@query("qualify_latest", on_events(f"""
SELECT user_id, event_id, event_type, {text('event_time')} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) AS n
  FROM events_flat) AS events_flat
WHERE n = 1"""))
def qualify_latest(ws):
    events = ws.events.select("user_id", "event_id", "event_type", "event_time")
    return latest_per_key(events, ["user_id"], ["event_time", "event_id"])


STAGED = HEADER + ", src_filename, " + text("loaded_at")


@query("stg_events", on_events(f"SELECT {STAGED} FROM events_flat"))
def stg_events(ws):
    return mart.stg_events(ws.raw)


def with_redelivery(raw):
    """RAW after a forced reload of everything from 2000 on: the same documents, loaded later."""
    again = raw.where(mart.event_time() >= F.lit("2000-01-01").cast("timestamp_ntz")).select(
        "raw", F.lit("reload.json").alias("src_filename"),
        F.timestamp_add("DAY", F.lit(1), F.col("loaded_at")).alias("loaded_at"))
    return raw.unionByName(again)


REDELIVERED = "event_time >= TIMESTAMP '2000-01-01'"


@query("stg_events_dedup", on_events(f"""
SELECT DISTINCT {HEADER},
       CASE WHEN {REDELIVERED.replace('event_time', 'events_flat.event_time')}
            THEN 'reload.json' ELSE src_filename END AS src_filename,
       CAST(CASE WHEN {REDELIVERED.replace('event_time', 'events_flat.event_time')}
            THEN loaded_at + INTERVAL 1 DAY ELSE loaded_at END AS VARCHAR) AS loaded_at
FROM events_flat"""))
def stg_events_dedup(ws):
    return mart.stg_events_latest(with_redelivery(ws.raw))


@query("stg_event_items", on_lines(f"""
SELECT event_id, user_id, {text('event_time')}, sku, product_name, category, qty,
       {double('price', 'line_amount')}, CAST(line_no AS BIGINT) AS line_no, src_filename,
       {text('loaded_at')}
FROM lines"""))
def stg_event_items(ws):
    return mart.stg_event_items(ws.raw)


@query("dyn_stg_events", on_events(f"""
SELECT event_id, user_id, event_type, {text('event_time')}, {DEVICE_TEXT}, src_filename,
       {text('loaded_at')}
FROM events_flat"""))
def dyn_stg_events(ws):
    return mart.dyn_stg_events(ws.raw)


@query("raw_vs_staging", on_lines("""
, totals AS (
  SELECT count(*) AS row_count, CAST(sum(qty) AS BIGINT) AS total_qty,
         CAST(sum(price) AS DOUBLE) AS price_sum
  FROM lines)
SELECT 'raw' AS layer, * FROM totals UNION ALL SELECT 'staging', * FROM totals"""))
def raw_vs_staging(ws):
    def totals(rows, layer):
        return rows.agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("qty").alias("total_qty"),
            F.sum("price").alias("price_sum")).select(F.lit(layer).alias("layer"), "*")

    from_raw = flatten(ws.raw, "items").select(
        path("value", "qty", "bigint").alias("qty"), path("value", "price", MONEY).alias("price"))
    return totals(from_raw, "raw").unionByName(totals(ws.event_items, "staging"))


@query("merge_dedupe", with_ctes(LINES, EVENTS, select=f"""
SELECT event_id, user_id, {text('event_time')}, sku, product_name, category, qty,
       {double('price', 'line_amount')}, CAST(line_no AS BIGINT) AS line_no,
       CASE WHEN {REDELIVERED.replace('event_time', 'lines.event_time')} THEN 'reload.json'
            ELSE src_filename END AS src_filename,
       CAST(CASE WHEN {REDELIVERED.replace('event_time', 'lines.event_time')}
            THEN loaded_at + INTERVAL 1 DAY ELSE loaded_at END AS VARCHAR) AS loaded_at
FROM (SELECT *, row_number() OVER (PARTITION BY event_id, sku ORDER BY line_no DESC) AS copy
      FROM lines) AS lines
WHERE copy = 1"""))
def merge_dedupe(ws):
    return mart.merge_source(mart.stg_event_items(with_redelivery(ws.raw)))
