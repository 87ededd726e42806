"""Queries for readers of the mart: governance, sharing, layout, metrics and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlet.functions.scalar import mean
from martlet.operators import governance, layout, quality
from martlet.operators import rollup as bitmaps
from martlet.operators.quality_state import QualityStates
from martlet.plans import mart
from martlet.plans.metrics import Dimension, MetricModel, Relationship
from martlet.plans.oracle import LINES, double, on_detail, on_events, on_fact, on_star, text, with_ctes
from martlet.plans.registry import query
from martlet.plans.relational import v_sales_detail
from martlet.sizing import limit, stored

# Roles of the mart.
ADMINS = frozenset({"engineer", "admin"})
USER_MASK = {"user_id": governance.Mask(ADMINS)}


def sku_policy():
    return governance.RowPolicy(ADMINS, {"analyst": F.col("sku").like("1%")})


FACT = (f"event_id, {text('event_time')}, sku, product_name, category, qty, "
        f"{double('price', 'line_amount')}, src_filename")


@query("mask_column", on_fact(f"""
SELECT {FACT}, regexp_replace(user_id, '.', '*', 'g') AS user_id FROM fact"""))
def mask_column(ws):
    return governance.apply_masks(ws.fact, "analyst", USER_MASK)


@query("row_policy", on_fact("""
SELECT 'admin' AS role, sku, count(*) AS row_count FROM fact GROUP BY sku
UNION ALL
SELECT 'analyst', sku, count(*) FROM fact WHERE sku LIKE '1%' GROUP BY sku"""))
def row_policy(ws):
    views = [
        governance.apply_row_policy(ws.fact, role, sku_policy()).groupBy("sku").agg(
            F.count(F.lit(1)).alias("row_count")).select(F.lit(role).alias("role"), "*")
        for role in ("admin", "analyst", "visitor")
    ]
    return views[0].unionByName(views[1]).unionByName(views[2])


@query("governed_read", on_fact(f"""
SELECT {FACT}, regexp_replace(user_id, '.', '*', 'g') AS user_id FROM fact WHERE sku LIKE '1%'"""))
def governed_read(ws):
    return governance.governed(ws.fact, "analyst", sku_policy(), USER_MASK)


@query("rows_for_principal", on_fact(f"""
SELECT {FACT}, user_id FROM fact WHERE user_id = '7'"""))
def rows_for_principal(ws, principal="7"):
    return governance.rows_of_principal(ws.fact, "user_id", principal)


@query("publish_public", on_detail(f"""
SELECT {text('purchase_date')}, prefecture, category, qty, {double('line_amount')} FROM detail"""))
def publish_public(ws):
    where = ws.location("sales_public")
    columns = ("purchase_date", "prefecture", "category", "qty", "line_amount")
    ws.once("sales_public", lambda: governance.publish(v_sales_detail(ws), columns, where))
    return ws.spark.read.parquet(where)


@query("share_fact", on_fact(f"""
SELECT event_id, {text('event_time')}, sku, category, qty, {double('line_amount')} FROM fact"""))
def share_fact(ws):
    return mart.shared_fact(ws.fact)


# ---- layout --------------------------------------------------------------------------------


# A file has several row groups, so that one file too is read by many tasks and pruned inside.
ROW_GROUPS = {"parquet.block.size": str(16 * 1024 * 1024)}


def _clustered(ws):
    return ws.table("fact_clustered", lambda: layout.clustered(
        ws.fact, [F.to_date("event_time"), F.col("category")], ["event_id", "sku"],
        limit(ws.spark, "fileRows")), **ROW_GROUPS)


@query("clustered_copy", on_fact(f"SELECT {FACT}, user_id FROM fact"))
def clustered_copy(ws):
    return _clustered(ws)


@query("clustered_curve", on_fact(f"SELECT {FACT}, user_id FROM fact"))
def clustered_curve(ws):
    """The same rows in files along a curve through days and categories, so that either prunes."""
    return ws.table("fact_curve", lambda: layout.clustered_curve(
        ws.fact, [F.to_date("event_time"), F.col("category")], ["event_id", "sku"],
        limit(ws.spark, "fileRows")), **ROW_GROUPS)


@query("clustering_report")
def clustering_report(ws):
    day = F.to_date("event_time")
    plain = layout.clustering_report(ws.fact, day).select(F.lit("plain").alias("layout"), "*")
    return plain.unionByName(layout.clustering_report(_clustered(ws), day).select(
        F.lit("clustered").alias("layout"), "*"))


@query("range_overlap", """
WITH ranges AS (
  SELECT o_custkey, min(o_orderdate) AS low, max(o_orderdate) AS high FROM orders GROUP BY 1),
counted AS (
  SELECT a.o_custkey, a.low, a.high, count(*) - 1 AS others,
         count(*) FILTER (WHERE b.low <= a.low AND b.high >= a.low) AS at_start
  FROM ranges a JOIN ranges b ON b.low <= a.high AND b.high >= a.low GROUP BY a.o_custkey, a.low, a.high)
SELECT count(*) AS users, count(*) FILTER (WHERE low = high) AS users_of_one_moment,
       round(avg(others), 4) AS average_overlapping, round(avg(at_start), 4) AS average_active_at_start
FROM counted""")
def range_overlap(ws):
    """How many users' times from first to last order overlap, by a sweep over their ends."""
    ranges = ws.source("orders").groupBy(F.col("o_custkey").alias("file")).agg(
        F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high"))
    return layout.overlap_report(ranges).toDF(
        "users", "users_of_one_moment", "average_overlapping", "average_active_at_start")


@query("pruned_day_sales", on_fact("""
SELECT CAST(sum(line_amount) AS DOUBLE) AS sales FROM fact
WHERE CAST(event_time AS DATE) = DATE '1998-07-31' - 7"""))
def pruned_day_sales(ws, as_of="1998-07-31", days=7):
    # The same filter as filter_recent_day, on the clustered copy: few files can hold the day.
    start = F.date_sub(F.lit(as_of).cast("date"), days)
    moment = F.col("event_time")
    return _clustered(ws).where(
        (moment >= start.cast("timestamp_ntz"))
        & (moment < F.date_add(start, 1).cast("timestamp_ntz"))
    ).agg(F.sum("line_amount").alias("sales"))


# ---- metrics -------------------------------------------------------------------------------


def purchase_model(ws) -> MetricModel:
    return MetricModel(
        fact=ws.fact,
        tables={"users": ws.users, "products": ws.products},
        keys={"users": "user_id", "products": "sku"},
        relationships=[Relationship("user_id", "users"), Relationship("sku", "products")],
        dimensions={
            "event_time_dim": Dimension("event_time"),
            "category_dim": Dimension("category"),
            "user_name_dim": Dimension("user_name", "users"),
            "prefecture_dim": Dimension("prefecture", "users"),
            "product_name_dim": Dimension("product_name", "products"),
            "product_category_dim": Dimension("category", "products"),
        },
        metrics={
            "total_sales": F.sum("line_amount"),
            "total_qty": F.sum("qty"),
            "order_count": F.count_distinct("event_id"),
            "avg_price": mean("price", None),
            "max_line_amount": F.max("line_amount"),
            "bulk_sales": F.sum("bulk_amount"),
        },
        facts={"bulk_amount": F.when(F.col("qty") >= 40, F.col("line_amount")).otherwise(0)},
    )


@query("metric_sales_by_region", on_star("""
SELECT u.prefecture AS prefecture_dim, CAST(sum(f.line_amount) AS DOUBLE) AS total_sales
FROM fact f JOIN users u ON u.user_id = f.user_id GROUP BY u.prefecture"""))
def metric_sales_by_region(ws):
    return purchase_model(ws).query(["total_sales"], ["prefecture_dim"])


@query("metric_all", on_star("""
SELECT u.prefecture AS prefecture_dim, p.category AS product_category_dim,
       CAST(sum(f.line_amount) AS DOUBLE) AS total_sales, CAST(sum(f.qty) AS BIGINT) AS total_qty,
       count(DISTINCT f.event_id) AS order_count,
       CAST(sum(f.price) AS DOUBLE) / count(f.price) AS avg_price
FROM fact f JOIN users u ON u.user_id = f.user_id JOIN products p ON p.sku = f.sku
GROUP BY u.prefecture, p.category"""))
def metric_all(ws):
    return purchase_model(ws).query(
        ["total_sales", "total_qty", "order_count", "avg_price"],
        ["prefecture_dim", "product_category_dim"])


@query("metric_facts", on_fact("""
SELECT category AS category_dim,
       CAST(sum(CASE WHEN qty >= 40 THEN line_amount ELSE 0 END) AS DOUBLE) AS bulk_sales,
       CAST(sum(line_amount) AS DOUBLE) AS total_sales
FROM fact GROUP BY category"""))
def metric_facts(ws):
    return purchase_model(ws).query(["bulk_sales", "total_sales"], ["category_dim"])


@query("metric_max_line", on_star("""
SELECT p.product_name AS product_name_dim, CAST(max(f.line_amount) AS DOUBLE) AS max_line_amount
FROM fact f JOIN products p ON p.sku = f.sku
GROUP BY p.product_name"""))
def metric_max_line(ws):
    return purchase_model(ws).query(["max_line_amount"], ["product_name_dim"])


# ---- quality -------------------------------------------------------------------------------


# ---- distinct counts from bitmaps ------------------------------------------------------------


def _order_rollup(ws):
    """Bitmaps of events by day and category, of two batches: the later one numbers on and is merged by any query."""
    def build():
        facts = ws.fact.select(F.to_date("event_time").alias("day"), "category", "event_id")
        early = F.col("day") < F.lit("1997-01-01").cast("date")
        first, second = facts.where(early), facts.where(~early)
        numbers = ws.table("event_numbers_first", lambda: bitmaps.number_values(first, "event_id"))
        more = ws.table("event_numbers", lambda: bitmaps.number_values(second, "event_id", numbers))
        by = ["day", "category"]
        return bitmaps.rollup(first, by, "event_id", numbers).unionByName(bitmaps.rollup(second, by, "event_id", more))

    return ws.table("event_rollup", build)


@query("metric_distinct_rollup", on_fact("""
SELECT CAST(year(event_time) AS INTEGER) AS year_num, category, count(DISTINCT event_id) AS order_count
FROM fact GROUP BY ALL
UNION ALL SELECT CAST(year(event_time) AS INTEGER), NULL, count(DISTINCT event_id) FROM fact GROUP BY ALL
UNION ALL SELECT NULL, category, count(DISTINCT event_id) FROM fact GROUP BY ALL
UNION ALL SELECT NULL, NULL, count(DISTINCT event_id) FROM fact"""))
def metric_distinct_rollup(ws):
    """Orders by year and category, by each alone and in all, each from the stored bitmaps of days."""
    stored_rollup, year = _order_rollup(ws), F.year("day").alias("year_num")
    out = None
    for by in ([year, "category"], [year], ["category"], []):
        counts = bitmaps.distinct_counts(stored_rollup, by, "order_count")
        out = counts if out is None else out.unionByName(counts, allowMissingColumns=True)
    return out


@query("dq_not_null", on_fact("""
SELECT 'event_id' AS column_name, count(*) - count(event_id) AS null_count FROM fact
UNION ALL SELECT 'user_id', count(*) - count(user_id) FROM fact
UNION ALL SELECT 'sku', count(*) - count(sku) FROM fact
UNION ALL SELECT 'src_filename', count(*) - count(src_filename) FROM fact"""))
def dq_not_null(ws):
    return quality.null_counts(ws.fact, ["event_id", "user_id", "sku", "src_filename"])


@query("dq_unique", on_star("""
SELECT 'fact' AS table_name, count(*) AS duplicate_keys FROM (
  SELECT event_id, sku FROM fact GROUP BY event_id, sku HAVING count(*) > 1)
UNION ALL SELECT 'stg_event_items', count(*) FROM (
  SELECT event_id, sku FROM lines GROUP BY event_id, sku HAVING count(*) > 1)
UNION ALL SELECT 'dim_users', count(*) FROM (
  SELECT user_id FROM users GROUP BY user_id HAVING count(*) > 1)
UNION ALL SELECT 'dim_products', count(*) FROM (
  SELECT sku FROM products GROUP BY sku HAVING count(*) > 1)"""))
def dq_unique(ws):
    checks = {
        "fact": (ws.fact, ["event_id", "sku"]), "stg_event_items": (ws.event_items, ["event_id", "sku"]),
        "dim_users": (ws.users, ["user_id"]), "dim_products": (ws.products, ["sku"])}
    out = None
    for name, (table, key) in checks.items():
        found = quality.duplicate_keys(table, key).agg(F.count(F.lit(1)).alias("duplicate_keys"))
        found = found.select(F.lit(name).alias("table_name"), "duplicate_keys")
        out = found if out is None else out.unionByName(found)
    return out


@query("dq_row_count", on_fact("SELECT count(*) AS row_count FROM fact"))
def dq_row_count(ws):
    return quality.row_count(ws.fact)


@query("dq_empty_alert", on_fact("""
SELECT 'no lines below zero' AS message FROM fact WHERE line_amount < 0 HAVING count(*) = 0
UNION ALL
SELECT 'the fact is empty' FROM fact HAVING count(*) = 0"""))
def dq_empty_alert(ws):
    return quality.empty_alert(
        ws.fact.where(F.col("line_amount") < 0), "no lines below zero"
    ).unionByName(quality.empty_alert(ws.fact, "the fact is empty"))


@query("dq_expected_counts", on_fact("""
SELECT 'category' AS column_name, count(DISTINCT category) AS found, CAST(5 AS BIGINT) AS expected
FROM fact HAVING count(DISTINCT category) <> 5"""))
def dq_expected_counts(ws):
    return quality.distinct_count_mismatch(ws.fact, {"category": 5})


@query("dq_consistency", on_fact("""
SELECT product_name, count(*) AS versions
FROM (SELECT DISTINCT product_name, category FROM fact) AS pairs
GROUP BY product_name HAVING count(*) > 1"""))
def dq_consistency(ws):
    return quality.inconsistent_attributes(ws.fact, "product_name", ["category"])


@query("dq_consistency_sku", on_fact("""
SELECT sku, count(*) AS versions
FROM (SELECT DISTINCT sku, product_name, category FROM fact) AS pairs
GROUP BY sku HAVING count(*) > 1"""))
def dq_consistency_sku(ws):
    return quality.inconsistent_attributes(ws.fact, "sku", ["product_name", "category"])


@query("dq_incremental", with_ctes(LINES, select="""
, numbered AS (
  SELECT *, CASE WHEN loaded_at < TIMESTAMP '1996-01-01' THEN 1 WHEN loaded_at < TIMESTAMP '1998-01-01' THEN 2 ELSE 3 END AS batch
  FROM lines),
so_far AS (SELECT b.after_batch, n.* FROM (VALUES (1), (2), (3)) AS b(after_batch) JOIN numbered n ON n.batch <= b.after_batch)
SELECT after_batch, 'rows' AS "check", '*' AS name, count(*) AS found FROM so_far GROUP BY after_batch
UNION ALL SELECT after_batch, 'nulls', 'event_id', count(*) - count(event_id) FROM so_far GROUP BY after_batch
UNION ALL SELECT after_batch, 'nulls', 'src_filename', count(*) - count(src_filename) FROM so_far GROUP BY after_batch
UNION ALL SELECT after_batch, 'duplicate keys', 'event_id, sku', count(*) FILTER (WHERE n > 1) FROM (
  SELECT after_batch, event_id, sku, count(*) AS n FROM so_far GROUP BY ALL) GROUP BY after_batch
UNION ALL SELECT after_batch, 'distinct values', 'category', count(DISTINCT category) FROM so_far GROUP BY after_batch
UNION ALL SELECT after_batch, 'inconsistent', 'product_name', count(*) FILTER (WHERE n > 1) FROM (
  SELECT after_batch, product_name, count(DISTINCT category) AS n FROM so_far GROUP BY ALL) GROUP BY after_batch
UNION ALL SELECT after_batch, 'inconsistent', 'sku', count(*) FILTER (WHERE n > 1) FROM (
  SELECT after_batch, sku, count(DISTINCT product_name || category) AS n FROM so_far GROUP BY ALL) GROUP BY after_batch"""))
def dq_incremental(ws):
    """The checks after each of three batches, from stored states of the batches before."""
    items = ws.event_items
    loaded = F.col("loaded_at")
    first, second = (F.lit(t).cast("timestamp_ntz") for t in ("1996-01-01", "1998-01-01"))
    states = QualityStates(
        ws.spark, ws.location("quality_states"), items.schema, ["event_id", "sku"], ["event_id", "src_filename"], ["category"],
        {"product_name": ["category"], "sku": ["product_name", "category"]})

    def build():
        out = None
        for n, rows in enumerate((
                items.where(loaded < first), items.where((loaded >= first) & (loaded < second)), items.where(loaded >= second)), 1):
            states.add(n, rows)
            found = states.findings().select(F.lit(n).alias("after_batch"), "*")
            found = stored(found)  # the next batch changes the states that this reads
            out = found if out is None else out.unionByName(found)
            if n == 2:
                states.fold()
        return out

    return ws.table("quality_findings", build)
