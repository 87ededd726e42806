"""Queries on the upsert log: merge, change feeds, past states, compaction, update and delete."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlet.operators import history
from martlet.plans import mart
from martlet.plans.oracle import LINES, double, on_fact, text, with_ctes
from martlet.plans.registry import query
from martlet.sizing import tasks_for

KEY = list(mart.FACT_KEY)
PAYLOAD = [c for c in mart.FACT_COLUMNS if c not in KEY]
FACT = (f"event_id, user_id, {text('event_time')}, sku, product_name, category, qty, "
        f"{double('price', 'line_amount')}, src_filename")
STATE = FACT + ", " + text("inserted_at")
SPLIT = "2000-01-01"  # fixed value: load date between the first and the second batch


def _moment(value):
    return F.lit(value).cast("timestamp_ntz")


# ---- change feed ---------------------------------------------------------------------------

SNAPSHOTS = """
old_rows AS (
  SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1999-07-01' THEN 'O'
                          ELSE o_orderstatus END AS status, o_orderpriority AS priority
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
new_rows AS (
  SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority
  FROM orders WHERE o_totalprice >= 50000),
feed AS (
  SELECT o.*, 'DELETE' AS _action, n.o_orderkey IS NOT NULL AS _is_update
  FROM old_rows o LEFT JOIN new_rows n ON n.o_orderkey = o.o_orderkey
  WHERE n.o_orderkey IS NULL OR (o.status, o.priority) IS DISTINCT FROM (n.status, n.priority)
  UNION ALL
  SELECT n.*, 'INSERT', o.o_orderkey IS NOT NULL
  FROM new_rows n LEFT JOIN old_rows o ON n.o_orderkey = o.o_orderkey
  WHERE o.o_orderkey IS NULL OR (o.status, o.priority) IS DISTINCT FROM (n.status, n.priority))"""


def _order_feed(ws):
    """Two versions of an order table: later orders appear, small ones vanish, statuses settle."""
    orders = ws.source("orders")
    placed = F.col("o_orderdate")
    old = orders.where(placed < _moment("2000-01-01")).select(
        "o_orderkey",
        F.when(placed >= _moment("1999-07-01"), "O").otherwise(F.col("o_orderstatus")).alias("status"),
        F.col("o_orderpriority").alias("priority"))
    new = orders.where(F.col("o_totalprice") >= 50000).select(
        "o_orderkey", F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"))
    return history.change_feed(old, new, ["o_orderkey"])


@query("change_feed", with_ctes(SNAPSHOTS, select="SELECT * FROM feed"))
def change_feed(ws):
    return _order_feed(ws)


@query("change_feed_inserts", with_ctes(
    SNAPSHOTS, select="SELECT * FROM feed WHERE _action = 'INSERT'"))
def change_feed_inserts(ws):
    return history.inserts(_order_feed(ws))


# ---- merge ---------------------------------------------------------------------------------

BATCHES = LINES + f""",
fact AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id, sku ORDER BY line_no DESC) AS copy FROM lines)
  AS numbered WHERE copy = 1),
first_load AS (SELECT * FROM fact WHERE loaded_at < TIMESTAMP '{SPLIT}'),
second_load AS (
  SELECT event_id, user_id, event_time, sku, product_name, category, qty + 1 AS qty, price,
         CAST((qty + 1) * price AS DECIMAL(12,2)) AS line_amount, 'second.json' AS src_filename
  FROM fact WHERE loaded_at >= TIMESTAMP '1999-01-01')"""


def _loads(ws):
    """A first load up to SPLIT, and a later one that corrects and extends it by a year's overlap."""
    rows = mart.merge_stored(ws.event_items).select(*mart.FACT_COLUMNS, "loaded_at")
    first = rows.where(F.col("loaded_at") < _moment(SPLIT)).drop("loaded_at")
    second = rows.where(F.col("loaded_at") >= _moment("1999-01-01")).drop("loaded_at").withColumns({
        "qty": F.col("qty") + 1,
        "line_amount": ((F.col("qty") + 1) * F.col("price")).cast("decimal(12,2)"),
        "src_filename": F.lit("second.json"),
    })
    return first, second


@query("merge_upsert", with_ctes(BATCHES, select=f"""
SELECT event_id, s.user_id, CAST(s.event_time AS VARCHAR) AS event_time, sku, s.product_name,
       s.category, s.qty, CAST(s.price AS DOUBLE) AS price,
       CAST(s.line_amount AS DOUBLE) AS line_amount, s.src_filename,
       CASE WHEN t.event_id IS NULL THEN '2002-01-02 00:00:00' ELSE '2002-01-01 00:00:00' END
         AS inserted_at
FROM second_load s LEFT JOIN first_load t USING (event_id, sku)
UNION ALL
SELECT event_id, t.user_id, CAST(t.event_time AS VARCHAR), sku, t.product_name, t.category, t.qty,
       CAST(t.price AS DOUBLE), CAST(t.line_amount AS DOUBLE), t.src_filename, '2002-01-01 00:00:00'
FROM first_load t LEFT JOIN second_load s USING (event_id, sku) WHERE s.event_id IS NULL"""))
def merge_upsert(ws):
    first, second = _loads(ws)
    log = history.log_rows(first, 1, _moment("2002-01-01")).unionByName(
        history.log_rows(second, 2, _moment("2002-01-02")))
    return history.current_state(log, KEY)


@query("merge_insert_only", with_ctes(BATCHES, select=f"""
SELECT {FACT} FROM first_load AS fact
UNION ALL
SELECT {FACT} FROM second_load AS fact
WHERE (event_id, sku) NOT IN (SELECT event_id, sku FROM first_load)"""))
def merge_insert_only(ws):
    first, second = _loads(ws)
    return first.unionByName(history.only_new(second, first, KEY))


# ---- past states ---------------------------------------------------------------------------

# The log of the queries below: items arrive in the batch of their load year; PROMO items are
# corrected a year later; cheap SMALL items are deleted a year later, and some come back after that.
LOG = LINES + """,
fact_lines AS (
  SELECT * FROM (
    SELECT *, CAST(year(loaded_at) AS BIGINT) AS load_year,
           row_number() OVER (PARTITION BY event_id, sku ORDER BY line_no DESC) AS copy
    FROM lines) AS numbered
  WHERE copy = 1),
log AS (
  SELECT event_id, user_id, event_time, sku, product_name, category, qty, price, line_amount,
         src_filename, 'U' AS op, load_year AS batch FROM fact_lines
  UNION ALL
  SELECT event_id, user_id, event_time, sku, product_name, category, qty + 1, price,
         CAST((qty + 1) * price AS DECIMAL(12,2)), 'fix.json', 'U', load_year + 1
  FROM fact_lines WHERE category = 'PROMO'
  UNION ALL
  SELECT event_id, user_id, event_time, sku, product_name, category, qty, price, line_amount,
         src_filename, 'D', load_year + 1
  FROM fact_lines WHERE category = 'SMALL' AND line_amount < 20000
  UNION ALL
  SELECT event_id, user_id, event_time, sku, product_name, category, qty, price, line_amount,
         'back.json', 'U', load_year + 2
  FROM fact_lines WHERE category = 'SMALL' AND line_amount < 5000)"""


def _state_sql(bound: str, select: str = f"SELECT {STATE} FROM state AS fact") -> str:
    return with_ctes(LOG, select=f"""
, bounded AS (SELECT *, make_timestamp(batch + 1, 1, 1, 0, 0, 0.0) AS commit_ts FROM log),
visible AS (SELECT * FROM bounded WHERE {bound}),
gone AS (SELECT event_id, sku, max(batch) AS gone_in FROM visible WHERE op = 'D' GROUP BY ALL),
alive AS (
  SELECT v.* FROM visible v LEFT JOIN gone g ON g.event_id = v.event_id AND g.sku = v.sku
  WHERE v.op = 'U' AND (g.gone_in IS NULL OR v.batch > g.gone_in)),
state AS (
  SELECT * FROM (
    SELECT *, min(commit_ts) OVER (PARTITION BY event_id, sku) AS inserted_at,
           row_number() OVER (PARTITION BY event_id, sku ORDER BY batch DESC) AS version
    FROM alive) AS versions
  WHERE version = 1)
{select}""")


def _log(ws):
    def build():
        rows = mart.merge_stored(ws.event_items).select(
            *mart.FACT_COLUMNS, F.year("loaded_at").cast("bigint").alias("year"))

        def batch(selected, later, op=history.UPSERT):
            year = F.col("year") + later
            commit = F.make_timestamp_ntz(
                (year + 1).cast("int"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
            return history.log_rows(selected, year, commit, op).drop("year")

        amount, category = F.col("line_amount"), F.col("category")
        fixed = rows.where(category == "PROMO").withColumns({
            "qty": F.col("qty") + 1,
            "line_amount": ((F.col("qty") + 1) * F.col("price")).cast("decimal(12,2)"),
            "src_filename": F.lit("fix.json")})
        small = rows.where(category == "SMALL")
        return (
            batch(rows, 0)
            .unionByName(batch(fixed, 1))
            .unionByName(batch(small.where(amount < 20000), 1, history.DELETE))
            .unionByName(batch(small.where(amount < 5000).withColumn(
                "src_filename", F.lit("back.json")), 2))
        )

    where = ws.location("fact_log")
    ws.once("fact_log", lambda: history.append_batch(build(), where))
    return history.read_log(ws.spark, where)


@query("as_of_timestamp", _state_sql("commit_ts <= TIMESTAMP '2000-01-01'"))
def as_of_timestamp(ws):
    return history.as_of(_log(ws), KEY, _moment("2000-01-01"))


@query("as_of_offset", _state_sql(
    "commit_ts <= TIMESTAMP '2002-06-01' - INTERVAL 31536000 SECOND"))
def as_of_offset(ws):
    return history.as_of_offset(_log(ws), KEY, _moment("2002-06-01"), 31_536_000)


@query("as_of_before", _state_sql("batch < 1999"))
def as_of_before(ws):
    return history.before_batch(_log(ws), KEY, 1999)


@query("current_state", _state_sql("true"))
def current_state(ws):
    log = _log(ws)
    return history.current_state(log, KEY, tasks_for(log))


@query("snapshot_table", _state_sql("commit_ts <= TIMESTAMP '1998-01-01'"))
def snapshot_table(ws):
    return ws.table("snapshot_1998", lambda: history.as_of(_log(ws), KEY, _moment("1998-01-01")))


@query("compact_history", _state_sql("commit_ts <= TIMESTAMP '2001-01-01'"))
def compact_history(ws):
    # Everything up to 2000 folded into a base; the state a year later must not notice.
    folded = ws.table("fact_log_folded", lambda: history.compact(_log(ws), KEY, _moment("2000-01-01")))
    return history.as_of(folded, KEY, _moment("2001-01-01"))


@query("dml_update_delete", on_fact("""
SELECT event_id, user_id, CAST(event_time AS VARCHAR) AS event_time, sku, product_name,
       CASE WHEN category = 'LARGE' THEN 'XL' ELSE category END AS category,
       CASE WHEN category = 'LARGE' THEN qty * 2 ELSE qty END AS qty,
       CAST(price AS DOUBLE) AS price,
       CAST(CASE WHEN category = 'LARGE' THEN qty * 2 * price ELSE line_amount END AS DOUBLE)
         AS line_amount,
       src_filename, '2002-01-01 00:00:00' AS inserted_at
FROM fact WHERE NOT (category <> 'LARGE' AND event_time < TIMESTAMP '1996-01-01')"""))
def dml_update_delete(ws):
    base = history.log_rows(ws.fact, 1, _moment("2002-01-01"))
    state = history.current_state(base, KEY)
    large = F.col("category") == "LARGE"
    updated = history.update_rows(state, large, {
        "category": F.lit("XL"), "qty": F.col("qty") * 2,
        "line_amount": (F.col("qty") * 2 * F.col("price")).cast("decimal(12,2)")})
    deleted = history.delete_rows(state, ~large & (F.col("event_time") < _moment("1996-01-01")))
    log = (
        base
        .unionByName(history.log_rows(updated, 2, _moment("2002-01-02")))
        .unionByName(history.log_rows(deleted, 2, _moment("2002-01-02"), history.DELETE))
    )
    return history.current_state(log, KEY)
