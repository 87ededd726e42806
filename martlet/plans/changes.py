"""Queries on a keyed fact table: merged batch by batch, its change feed, and aggregates that follow it.

The table takes a first load, is folded into a bucketed base, and then takes a later load that corrects and extends
it, a replay of that load, and a batch that moves large items to another category and deletes old small ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators.keyed import KeyedTable
from martlet.operators.maintained import MaintainedAggregate, Measure
from martlet.plans import mart
from martlet.plans.history import BATCHES, STATE, _loads
from martlet.plans.oracle import USERS, text, with_ctes
from martlet.plans.registry import query
from martlet.sizing import limit, lookup_join, segment_count

KEY = list(mart.FACT_KEY)
BUCKETS = 16  # at least; a larger table has one for each task's rows

FINAL = BATCHES + """,
merged AS (
  SELECT s.*, CASE WHEN f.event_id IS NULL THEN '2002-01-02 00:00:00' ELSE '2002-01-01 00:00:00' END AS inserted_at
  FROM second_load s LEFT JOIN first_load f ON f.event_id = s.event_id AND f.sku = s.sku
  UNION ALL
  SELECT event_id, user_id, event_time, sku, product_name, category, qty, price, line_amount, src_filename,
         '2002-01-01 00:00:00'
  FROM first_load f WHERE NOT EXISTS (SELECT 1 FROM second_load s WHERE s.event_id = f.event_id AND s.sku = f.sku)),
final AS (
  SELECT event_id, user_id, event_time, sku, product_name,
         CASE WHEN moved THEN 'XL' ELSE category END AS category, CASE WHEN moved THEN qty * 2 ELSE qty END AS qty, price,
         CASE WHEN moved THEN CAST(qty * 2 * price AS DECIMAL(12,2)) ELSE line_amount END AS line_amount, src_filename,
         inserted_at
  FROM (SELECT *, category = 'LARGE' AND year(event_time) = 1998 AS moved FROM merged) AS marked
  WHERE NOT (category = 'SMALL' AND year(event_time) < 1996))"""


def _day(n: int):
    return F.lit(f"2002-01-0{n}").cast("timestamp_ntz")


def _monthly(rows):
    return rows.withColumns({"year_num": F.year("event_time"), "month_num": F.month("event_time")})


def _category_monthly(ws, table: KeyedTable) -> MaintainedAggregate:
    return MaintainedAggregate(
        table, f"{table.path}_groups", ["year_num", "month_num", "category"], {
            "items": Measure("count"), "total_qty": Measure("sum", "qty"), "sales_amount": Measure("sum", "line_amount"),
            "smallest_line": Measure("min", "line_amount"), "largest_line": Measure("max", "line_amount")}, _monthly, table.buckets)


def _user_ltv(ws, table: KeyedTable) -> MaintainedAggregate:
    return MaintainedAggregate(
        table, f"{table.path}_groups", ["user_id"], {
            "lifetime_value": Measure("sum", "line_amount"), "purchase_count": Measure("distinct", "event_id"),
            "last_purchase": Measure("max", "event_time")}, buckets=table.buckets)


def keyed_fact(ws, name: str = "keyed_fact", follower=None) -> KeyedTable:
    """The table after all batches; a ``follower`` is brought up to date after each."""
    columns = ws.event_items.schema
    schema = T.StructType([columns[c] for c in mart.FACT_COLUMNS])
    buckets = max(BUCKETS, segment_count(ws.event_items.count(), limit(ws.spark, "taskRows")))
    table = KeyedTable(ws.spark, ws.location(name), schema, KEY, buckets)

    def write() -> None:
        first, second = _loads(ws)
        aggregate = follower and follower(ws, table)

        def refresh(n: int) -> None:
            if aggregate:
                aggregate.refresh(_day(n))

        table.merge(1, first, None, _day(1))
        table.fold()
        refresh(1)
        if aggregate:
            aggregate.groups.fold()
        table.merge(2, second, None, _day(2))
        table.merge(2, second, None, _day(3))  # delivered again: changes nothing
        refresh(2)
        state, year = table.state().drop("inserted_at"), F.year("event_time")
        moved = state.where((F.col("category") == "LARGE") & (year == 1998)).withColumns({
            "category": F.lit("XL"), "qty": F.col("qty") * 2,
            "line_amount": (F.col("qty") * 2 * F.col("price")).cast("decimal(12,2)")})
        table.merge(3, moved, state.where((F.col("category") == "SMALL") & (year < 1996)), _day(3))
        refresh(3)

    ws.once(name, write)
    return table


@query("merge_bucketed", with_ctes(FINAL, select=f"SELECT {STATE} FROM final"))
def merge_bucketed(ws):
    return keyed_fact(ws).state()


@query("change_feed_log", with_ctes(FINAL, select=f"""
, before AS (SELECT *, '2002-01-01 00:00:00' AS inserted_at FROM first_load),
changed AS (
  SELECT event_id, sku FROM before b FULL JOIN final f USING (event_id, sku)
  WHERE b.qty IS NULL OR f.qty IS NULL
     OR (b.category, b.qty, b.line_amount, b.src_filename) IS DISTINCT FROM (f.category, f.qty, f.line_amount, f.src_filename))
SELECT {STATE}, 'DELETE' AS _action, EXISTS (SELECT 1 FROM final f WHERE f.event_id = b.event_id AND f.sku = b.sku) AS _is_update
FROM before b WHERE (event_id, sku) IN (SELECT event_id, sku FROM changed)
UNION ALL
SELECT {STATE}, 'INSERT', EXISTS (SELECT 1 FROM before b WHERE b.event_id = f.event_id AND b.sku = f.sku)
FROM final f WHERE (event_id, sku) IN (SELECT event_id, sku FROM changed)"""))
def change_feed_log(ws):
    """What batches 2 and 3 changed, from these batches alone."""
    return keyed_fact(ws).feed(1, 3)


@query("dyn_category_monthly", with_ctes(FINAL, select="""
SELECT CAST(year(event_time) AS INTEGER) AS year_num, CAST(month(event_time) AS INTEGER) AS month_num, category,
       count(*) AS items, CAST(sum(qty) AS BIGINT) AS total_qty, CAST(sum(line_amount) AS DOUBLE) AS sales_amount,
       CAST(min(line_amount) AS DOUBLE) AS smallest_line, CAST(max(line_amount) AS DOUBLE) AS largest_line
FROM final GROUP BY ALL"""))
def dyn_category_monthly(ws):
    return _category_monthly(ws, keyed_fact(ws, "keyed_fact_monthly", _category_monthly)).read()


@query("dyn_user_ltv", with_ctes(FINAL, USERS, select=f"""
SELECT user_id, user_name, prefecture, CAST(sum(line_amount) AS DOUBLE) AS lifetime_value,
       count(DISTINCT event_id) AS purchase_count, {text('max(event_time)').replace('AS max(event_time)', 'AS last_purchase')}
FROM final JOIN users USING (user_id) GROUP BY user_id, user_name, prefecture"""))
def dyn_user_ltv(ws):
    totals = _user_ltv(ws, keyed_fact(ws, "keyed_fact_ltv", _user_ltv)).read()
    return lookup_join(totals, ws.users, "user_id").select(
        "user_id", "user_name", "prefecture", "lifetime_value", "purchase_count", "last_purchase")
