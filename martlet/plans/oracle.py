"""Shared SQL for checking queries on another engine: the mart stated over the flat tables.

The queries reach these rows through JSON documents, parsing and flattening; the SQL never does.
"""

LINES = """
lines AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS event_id,
         CAST(o.o_custkey AS VARCHAR) AS user_id,
         CASE WHEN o.o_orderstatus <> 'P' THEN 'purchase' ELSE 'view' END AS event_type,
         o.o_orderdate + (o.o_orderkey % 86400) * INTERVAL 1 SECOND AS event_time,
         CAST(l.l_partkey AS VARCHAR) AS sku,
         p.p_name AS product_name,
         p.p_type AS category,
         CAST(l.l_quantity AS BIGINT) AS qty,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS price,
         CAST(CAST(l.l_quantity AS BIGINT) * CAST(p.p_retailprice AS DECIMAL(10,2))
              AS DECIMAL(12,2)) AS line_amount,
         CASE WHEN o.o_orderkey % 10 = 0 THEN NULL
              ELSE 'part-' || CAST(o.o_orderkey % 4 AS VARCHAR) || '.json' END AS src_filename,
         max(l.l_shipdate) OVER (PARTITION BY l.l_orderkey) AS loaded_at,
         l.l_shipdate AS shipped_at,
         row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_shipdate, l.l_suppkey,
           l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
           l.l_returnflag, l.l_linestatus, l.l_partkey) AS line_no
  FROM orders o
  JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  JOIN part p ON p.p_partkey = l.l_partkey)"""

FACT = LINES + """,
fact AS (
  SELECT event_id, user_id, event_time, sku, product_name, category, qty, price, line_amount,
         src_filename
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id, sku ORDER BY line_no DESC) AS copy
        FROM lines) AS numbered
  WHERE copy = 1)"""

USERS = """
users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS user_name, n_name AS prefecture
  FROM customer JOIN nation ON n_nationkey = c_nationkey)"""

PRODUCTS = """
products AS (SELECT DISTINCT sku, product_name, category FROM fact)"""

DATES = """
dates AS (
  SELECT DISTINCT CAST(event_time AS DATE) AS date_key,
         CAST(year(event_time) AS INTEGER) AS year_num,
         CAST(month(event_time) AS INTEGER) AS month_num,
         CAST(day(event_time) AS INTEGER) AS day_num
  FROM fact)"""

DETAIL = """
detail AS (
  SELECT f.event_id, f.event_time, d.date_key AS purchase_date, d.year_num, d.month_num, d.day_num,
         f.user_id, u.user_name, u.prefecture, f.sku, p.product_name, p.category,
         f.qty, f.price, f.line_amount
  FROM fact f
  JOIN users u ON u.user_id = f.user_id
  JOIN products p ON p.sku = f.sku
  JOIN dates d ON d.date_key = CAST(f.event_time AS DATE))"""

EVENTS = """
loads AS (
  SELECT l_orderkey, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey),
events_flat AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS event_id, CAST(o_custkey AS VARCHAR) AS user_id,
         CASE WHEN o_orderstatus <> 'P' THEN 'purchase' ELSE 'view' END AS event_type,
         o_orderdate + (o_orderkey % 86400) * INTERVAL 1 SECOND AS event_time,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL
              WHEN o_orderkey % 3 = 0 THEN 'iOS'
              WHEN o_orderkey % 3 = 1 THEN 'Android' ELSE 'PC' END AS device_os,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE '2.0.0' END AS app_version,
         CASE WHEN o_orderkey % 10 = 0 THEN NULL
              ELSE 'part-' || CAST(o_orderkey % 4 AS VARCHAR) || '.json' END AS src_filename,
         coalesce(last_ship, o_orderdate) AS loaded_at
  FROM orders LEFT JOIN loads ON l_orderkey = o_orderkey)"""


def with_ctes(*parts: str, select: str) -> str:
    """``select`` may begin with ", name AS (...)" to add tables of its own."""
    return "WITH " + ",".join(parts) + "\n" + select


def on_fact(select: str) -> str:
    return with_ctes(FACT, select=select)


def on_star(select: str) -> str:
    return with_ctes(FACT, USERS, PRODUCTS, DATES, select=select)


def on_detail(select: str) -> str:
    return with_ctes(FACT, USERS, PRODUCTS, DATES, DETAIL, select=select)


def on_events(select: str) -> str:
    return with_ctes(EVENTS, select=select)


def text(*columns: str) -> str:
    """Select items that print dates and timestamps as text."""
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


def double(*columns: str) -> str:
    """Select items that turn decimals into doubles."""
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
