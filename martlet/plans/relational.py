"""Relational queries on the purchase mart: select, where, join, group, set, subquery, functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlet.functions.scalar import iff, mean, month_start, safe_divide, share, tier
from martlet.operators import joins
from martlet.plans import mart
from martlet.plans.oracle import double, on_detail, on_fact, on_star, text, with_ctes, USERS
from martlet.plans.registry import query
from martlet.sizing import lookup_join

# Price tiers of the queries, highest threshold first.
TIERS = [(10000, "high"), (3000, "mid")]
TIERS_JA = [(10000, "高額"), (3000, "中額")]
RANKS_JA = [(10000, "高額"), (5000, "中額")]


def amount():
    return F.col("line_amount")


def moment():
    return F.col("event_time")


# ---- projections ---------------------------------------------------------------------------


@query("proj_columns", on_fact(
    f"SELECT event_id AS id, user_id AS uid, category, {double('line_amount')} FROM fact"))
def proj_columns(ws):
    return ws.fact.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("uid"), "category", "line_amount")


@query("proj_tax", on_fact("""
SELECT event_id, sku, qty, CAST(price AS DOUBLE) AS price,
       CAST(qty * price AS DOUBLE) AS computed_amount,
       CAST(line_amount AS DOUBLE) AS line_amount,
       CAST(line_amount * 1.1 AS DOUBLE) AS amount_with_tax
FROM fact"""))
def proj_tax(ws):
    return ws.fact.select(
        "event_id", "sku", "qty", "price",
        (F.col("qty") * F.col("price")).alias("computed_amount"),
        "line_amount",
        (amount() * F.lit("1.1").cast("decimal(2,1)")).alias("amount_with_tax"),
    )


@query("scan_count", on_fact("SELECT count(*) AS row_count FROM fact"))
def scan_count(ws):
    return ws.fact.agg(F.count(F.lit(1)).alias("row_count"))


# ---- filters -------------------------------------------------------------------------------

EVENT_AMOUNT = f"SELECT event_id, sku, category, {double('line_amount')} FROM fact WHERE "


def _amounts(ws, condition):
    return ws.fact.where(condition).select("event_id", "sku", "category", "line_amount")


@query("filter_compare", on_fact(
    EVENT_AMOUNT + "line_amount >= 10000 AND qty <> 13 AND price < 990 AND qty > 5 "
    "AND price <= 985 AND user_id = '7' OR line_amount >= 45000"))
def filter_compare(ws):
    qty, price = F.col("qty"), F.col("price")
    return _amounts(ws, (
        (amount() >= 10000) & (qty != 13) & (price < 990) & (qty > 5) & (price <= 985)
        & (F.col("user_id") == "7")) | (amount() >= 45000))


@query("filter_bool", on_fact(
    EVENT_AMOUNT + "(category = 'ECONOMY' AND line_amount >= 5000) "
    "OR (category = 'PROMO' AND NOT line_amount < 20000)"))
def filter_bool(ws):
    category = F.col("category")
    return _amounts(ws, ((category == "ECONOMY") & (amount() >= 5000))
                    | ((category == "PROMO") & ~(amount() < 20000)))


@query("filter_in", on_fact(
    EVENT_AMOUNT + "category IN ('ECONOMY', 'PROMO', 'Books') "
    "AND product_name NOT IN ('small ring')"))
def filter_in(ws):
    return _amounts(ws, F.col("category").isin("ECONOMY", "PROMO", "Books")
                    & ~F.col("product_name").isin("small ring"))


@query("filter_like", on_fact(
    "SELECT event_id, sku, product_name FROM fact "
    "WHERE product_name LIKE '%ring%' OR product_name LIKE 'small%' OR product_name LIKE 'h_t b%'"))
def filter_like(ws):
    name = F.col("product_name")
    return ws.fact.where(name.like("%ring%") | name.like("small%") | name.like("h_t b%")).select(
        "event_id", "sku", "product_name")


@query("filter_ilike", on_fact(
    "SELECT event_id, sku, product_name FROM fact WHERE product_name ILIKE '%RING%'"))
def filter_ilike(ws):
    return ws.fact.where(F.col("product_name").ilike("%RING%")).select(
        "event_id", "sku", "product_name")


@query("filter_between", on_fact(EVENT_AMOUNT + "line_amount BETWEEN 1000 AND 5000"))
def filter_between(ws):
    return _amounts(ws, amount().between(1000, 5000))


@query("filter_count", on_fact("""
SELECT count(*) AS high_value_count FROM fact WHERE category = 'PROMO' AND line_amount >= 3000"""))
def filter_count(ws):
    return ws.fact.where((F.col("category") == "PROMO") & (amount() >= 3000)).agg(
        F.count(F.lit(1)).alias("high_value_count"))


@query("filter_null", on_fact(
    "SELECT 'is not null' AS test, count(*) AS row_count FROM fact WHERE src_filename IS NOT NULL "
    "UNION ALL SELECT 'is null', count(*) FROM fact WHERE src_filename IS NULL "
    "UNION ALL SELECT 'equals null', count(*) FROM fact WHERE src_filename = NULL"))
def filter_null(ws):
    name = F.col("src_filename")
    # One scan: count_if skips a NULL condition exactly as WHERE does.
    counts = ws.fact.agg(
        F.count_if(name.isNotNull()).alias("a"),
        F.count_if(name.isNull()).alias("b"),
        F.count_if(name == F.lit(None).cast("string")).alias("c"),
    )
    return counts.select(F.stack(
        F.lit(3), F.lit("is not null"), "a", F.lit("is null"), "b", F.lit("equals null"), "c",
    ).alias("test", "row_count"))


@query("filter_recent_day", on_fact(
    "SELECT count(*) AS line_count, CAST(sum(line_amount) AS DOUBLE) AS sales FROM fact "
    "WHERE CAST(event_time AS DATE) = DATE '2001-07-31' - 7"))
def filter_recent_day(ws, as_of="2001-07-31", days=7):
    # Written as a half-open range on the stored column, so the file statistics can prune.
    day = F.date_sub(F.lit(as_of).cast("date"), days)
    start, end = day.cast("timestamp_ntz"), F.date_add(day, 1).cast("timestamp_ntz")
    return ws.fact.where((moment() >= start) & (moment() < end)).agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("line_amount").alias("sales"))


@query("filter_time_range", on_fact(
    f"SELECT event_id, sku, {text('event_time')} FROM fact "
    "WHERE event_time >= TIMESTAMP '1998-03-01' AND event_time < TIMESTAMP '1998-04-01'"))
def filter_time_range(ws):
    def at(text):
        return F.lit(text).cast("timestamp_ntz")

    return ws.fact.where((moment() >= at("1998-03-01")) & (moment() < at("1998-04-01"))).select(
        "event_id", "sku", "event_time")


# ---- joins ---------------------------------------------------------------------------------


@query("join_norm4", """
SELECT o.o_orderkey AS order_id, CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS order_date,
       c.c_name AS user_name, p.p_name AS product_name, p.p_type AS category,
       CAST(l.l_quantity AS BIGINT) AS qty,
       CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
       CAST(CAST(l.l_quantity AS BIGINT) * CAST(p.p_retailprice AS DECIMAL(10,2)) AS DOUBLE)
         AS line_amount
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN part p ON p.p_partkey = l.l_partkey""")
def join_norm4(ws):
    lines = lookup_join(
        ws.source("lineitem").select("l_orderkey", "l_partkey", "l_quantity"),
        ws.source("part").select("p_partkey", "p_name", "p_type", "p_retailprice"),
        F.col("l_partkey") == F.col("p_partkey"))
    orders = lookup_join(
        ws.source("orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        ws.source("customer").select("c_custkey", "c_name"),
        F.col("o_custkey") == F.col("c_custkey"))
    qty = F.col("l_quantity").cast("bigint")
    price = F.col("p_retailprice").cast("decimal(10,2)")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("c_name").alias("user_name"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), qty.alias("qty"), price.alias("price"),
        (qty * price).alias("line_amount"))


@query("star_category", on_star("""
SELECT p.category, CAST(sum(f.line_amount) AS DOUBLE) AS sales_amount
FROM fact f JOIN products p ON p.sku = f.sku GROUP BY p.category"""))
def star_category(ws):
    return joins.star_totals(
        ws.fact.select("sku", "line_amount"),
        [(ws.products.select("sku", "category"), "sku")],
        ["category"], {"sales_amount": "line_amount"},
    ).orderBy(F.desc("sales_amount"))


@query("star_category_region", on_star("""
SELECT p.category, u.prefecture, CAST(sum(f.line_amount) AS DOUBLE) AS sales_amount
FROM fact f JOIN products p ON p.sku = f.sku JOIN users u ON u.user_id = f.user_id
GROUP BY p.category, u.prefecture"""))
def star_category_region(ws):
    return joins.star_totals(
        ws.fact.select("sku", "user_id", "line_amount"),
        [(ws.products.select("sku", "category"), "sku"),
         (ws.users.select("user_id", "prefecture"), "user_id")],
        ["category", "prefecture"], {"sales_amount": "line_amount"},
    ).orderBy(F.desc("sales_amount"))


@query("star_month_category", on_star("""
SELECT d.year_num, d.month_num, p.category, CAST(sum(f.qty) AS BIGINT) AS total_qty,
       CAST(sum(f.line_amount) AS DOUBLE) AS sales_amount
FROM fact f JOIN products p ON p.sku = f.sku
JOIN dates d ON d.date_key = CAST(f.event_time AS DATE)
GROUP BY d.year_num, d.month_num, p.category"""))
def star_month_category(ws):
    fact = ws.fact.select("sku", F.to_date("event_time").alias("date_key"), "qty", "line_amount")
    return joins.star_totals(
        fact,
        [(ws.products.select("sku", "category"), "sku"),
         (ws.dates.select("date_key", "year_num", "month_num"), "date_key")],
        ["year_num", "month_num", "category"],
        {"total_qty": "qty", "sales_amount": "line_amount"},
    ).orderBy("year_num", "month_num", "category")


@query("join_left", """
SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def join_left(ws):
    # Some documents have no label.
    documents = ws.source("documents").select("doc_id", "lang", "source")
    return lookup_join(documents, ws.source("labels"), "doc_id", "left")


def _user_events(ws):
    return ws.source("events").select(
        "event_id", F.col("user_id").cast("string").alias("user_id"), "event_type")


@query("join_right", on_star("""
SELECT e.event_id, e.event_type, u.user_id, u.user_name
FROM events e RIGHT JOIN users u ON u.user_id = CAST(e.user_id AS VARCHAR)"""))
def join_right(ws):
    # Most users never appear in the event stream.
    return joins.keep_lookup_rows(_user_events(ws), ws.users.select("user_id", "user_name"), "user_id")


@query("join_full_unmatched", """
SELECT e.event_id, e.event_type, CAST(l.doc_id AS VARCHAR) AS labelled_id, l.quality
FROM events e FULL JOIN labels l ON l.doc_id = e.user_id
WHERE e.event_id IS NULL OR l.doc_id IS NULL""")
def join_full_unmatched(ws):
    # Users without a label of their number, and labels beyond the users: both sides keep rows.
    labels = ws.source("labels").select(F.col("doc_id").cast("string").alias("user_id"), "quality")
    both = joins.unmatched(_user_events(ws), labels, "user_id", "labelled_id")
    return both.select("event_id", "event_type", "labelled_id", "quality")


@query("join_anti", on_star("""
SELECT u.user_id, u.user_name FROM users u
LEFT JOIN events e ON u.user_id = CAST(e.user_id AS VARCHAR)
WHERE e.user_id IS NULL"""))
def join_anti(ws):
    seen = _user_events(ws).select("user_id").distinct()
    return ws.users.select("user_id", "user_name").join(seen, "user_id", "left_anti")


@query("join_semi", on_star(f"""
SELECT event_id, sku, product_name, {double('line_amount')} FROM fact
WHERE category IN (SELECT DISTINCT category FROM products WHERE category LIKE '%O%')"""))
def join_semi(ws):
    wanted = ws.products.where(F.col("category").like("%O%")).select("category").distinct()
    fact = ws.fact.select("event_id", "sku", "product_name", "line_amount", "category")
    return lookup_join(fact, wanted, "category", "left_semi").drop("category")


@query("join_fanout", """
SELECT e.event_id, e.user_id, e.event_type, CAST(e.ts AS VARCHAR) AS event_time, c.turn, c.role
FROM events e JOIN conversations c ON c.conv_id = e.user_id""")
def join_fanout(ws):
    events = ws.source("events").select(
        "event_id", "user_id", "event_type", F.col("ts").alias("event_time"))
    turns = ws.source("conversations").select(
        F.col("conv_id").alias("user_id"), "turn", "role")
    return events.join(turns, "user_id")


@query("join_self", on_fact("""
, monthly AS (
  SELECT user_id, date_trunc('month', event_time) AS sale_month,
         sum(line_amount) AS month_total
  FROM fact GROUP BY 1, 2)
SELECT a.user_id, CAST(CAST(a.sale_month AS TIMESTAMP) AS VARCHAR) AS sale_month,
       CAST(a.month_total AS DOUBLE) AS month_total,
       CAST(b.month_total AS DOUBLE) AS earlier_total
FROM monthly a JOIN monthly b
  ON b.user_id = a.user_id AND b.sale_month = a.sale_month - INTERVAL 1 MONTH""".lstrip()))
def join_self(ws):
    monthly = ws.fact.groupBy("user_id", month_start(moment()).alias("sale_month")).agg(
        F.sum("line_amount").alias("month_total"))
    now, before = monthly.alias("now"), monthly.alias("before")
    following = F.add_months(F.to_date("before.sale_month"), 1).cast("timestamp_ntz")
    return now.join(
        before,
        (F.col("now.user_id") == F.col("before.user_id")) & (F.col("now.sale_month") == following),
    ).select("now.user_id", "now.sale_month", "now.month_total",
             F.col("before.month_total").alias("earlier_total"))


@query("join_coverage", """
SELECT 'INNER JOIN' AS join_type, count(*) AS row_count
FROM documents d JOIN labels l ON l.doc_id = d.doc_id
UNION ALL
SELECT 'LEFT JOIN', count(*) FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def join_coverage(ws):
    # Counts per key on both sides, then one aggregate for both numbers: each table is read once.
    documents = ws.source("documents").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    labels = ws.source("labels").groupBy("doc_id").agg(F.count(F.lit(1)).alias("partners"))
    pairs = F.col("rows") * F.col("partners")
    totals = documents.join(labels, "doc_id", "left").agg(
        F.coalesce(F.sum(pairs), F.lit(0)).alias("inner"),
        F.coalesce(F.sum(F.coalesce(pairs, F.col("rows"))), F.lit(0)).alias("left"))
    return totals.select(F.inline(F.array(
        F.struct(F.lit("INNER JOIN").alias("join_type"), F.col("inner").alias("row_count")),
        F.struct(F.lit("LEFT JOIN").alias("join_type"), F.col("left").alias("row_count")))))


@query("join_three", on_star(f"""
SELECT f.event_id, f.sku, u.user_name, u.prefecture, p.category, p.product_name, f.qty,
       {double('line_amount')}
FROM fact f JOIN users u ON u.user_id = f.user_id JOIN products p ON p.sku = f.sku"""))
def join_three(ws):
    fact = ws.fact.select("event_id", "sku", "user_id", "qty", "line_amount")
    named = lookup_join(lookup_join(fact, ws.users, "user_id"), ws.products, "sku")
    return named.select("event_id", "sku", "user_name", "prefecture", "category", "product_name",
                        "qty", "line_amount")


@query("prefecture_sales", on_star("""
SELECT u.prefecture, CAST(sum(f.line_amount) AS DOUBLE) AS total_amount
FROM fact f JOIN users u ON u.user_id = f.user_id GROUP BY u.prefecture"""))
def prefecture_sales(ws):
    return joins.star_totals(
        ws.fact.select("user_id", "line_amount"),
        [(ws.users.select("user_id", "prefecture"), "user_id")],
        ["prefecture"], {"total_amount": "line_amount"},
    ).orderBy(F.desc("total_amount"))


@query("product_sales", on_star("""
SELECT p.category, p.product_name, count(*) AS sales_count,
       CAST(sum(f.line_amount) AS DOUBLE) AS total_amount
FROM fact f JOIN products p ON p.sku = f.sku GROUP BY p.category, p.product_name"""))
def product_sales(ws):
    return joins.star_totals(
        ws.fact.select("sku", F.lit(1).cast("bigint").alias("one"), "line_amount"),
        [(ws.products, "sku")], ["category", "product_name"],
        {"sales_count": "one", "total_amount": "line_amount"},
    ).orderBy("category", F.desc("total_amount"))


# ---- aggregation ---------------------------------------------------------------------------


@query("agg_global", on_fact("""
SELECT count(*) AS total_rows, count(event_id) AS non_null_rows,
       CAST(sum(line_amount) AS DOUBLE) AS total_sales,
       round(CAST(sum(line_amount) AS DOUBLE) / count(line_amount), 4) AS avg_sales,
       CAST(max(line_amount) AS DOUBLE) AS max_sale, CAST(min(line_amount) AS DOUBLE) AS min_sale
FROM fact"""))
def agg_global(ws):
    return ws.fact.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count("event_id").alias("non_null_rows"),
        F.sum("line_amount").alias("total_sales"), mean("line_amount").alias("avg_sales"),
        F.max("line_amount").alias("max_sale"), F.min("line_amount").alias("min_sale"))


@query("agg_by_category", on_fact("""
SELECT category, count(*) AS transaction_count, CAST(sum(line_amount) AS DOUBLE) AS total_sales,
       round(CAST(sum(line_amount) AS DOUBLE) / count(line_amount), 4) AS avg_sale,
       CAST(max(line_amount) AS DOUBLE) AS max_sale
FROM fact GROUP BY category"""))
def agg_by_category(ws):
    return ws.fact.groupBy("category").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("line_amount").alias("total_sales"),
        mean("line_amount").alias("avg_sale"), F.max("line_amount").alias("max_sale"),
    ).orderBy(F.desc("total_sales"))


@query("agg_by_two", on_fact("""
SELECT category, user_id, count(*) AS transaction_count,
       CAST(sum(line_amount) AS DOUBLE) AS total_sales
FROM fact GROUP BY category, user_id"""))
def agg_by_two(ws):
    return ws.fact.groupBy("category", "user_id").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("line_amount").alias("total_sales"))


@query("agg_having", on_fact("""
SELECT category, count(*) AS transaction_count, CAST(sum(line_amount) AS DOUBLE) AS total_sales
FROM fact GROUP BY category HAVING sum(line_amount) >= 50000"""))
def agg_having(ws):
    return ws.fact.groupBy("category").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("line_amount").alias("total_sales"),
    ).where(F.col("total_sales") >= 50000).orderBy(F.desc("total_sales"))


@query("agg_where_having", on_fact("""
SELECT category, count(*) AS transaction_count, CAST(sum(line_amount) AS DOUBLE) AS total_sales
FROM fact WHERE line_amount >= 1000 GROUP BY category HAVING count(*) >= 3"""))
def agg_where_having(ws):
    return ws.fact.where(amount() >= 1000).groupBy("category").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("line_amount").alias("total_sales"),
    ).where(F.col("transaction_count") >= 3).orderBy(F.desc("total_sales"))


@query("agg_user_having", on_fact("""
SELECT user_id, count(*) AS purchase_count FROM fact GROUP BY user_id HAVING count(*) >= 3"""))
def agg_user_having(ws):
    return ws.fact.groupBy("user_id").agg(F.count(F.lit(1)).alias("purchase_count")).where(
        F.col("purchase_count") >= 3)


@query("agg_global_having", on_fact("""
SELECT count(*) AS row_count FROM fact WHERE line_amount < 0 HAVING count(*) = 0"""))
def agg_global_having(ws):
    return ws.fact.where(amount() < 0).agg(F.count(F.lit(1)).alias("row_count")).where(
        F.col("row_count") == 0)


@query("agg_distinct", on_fact("""
SELECT count(DISTINCT user_id) AS unique_users, count(DISTINCT category) AS unique_categories
FROM fact"""))
def agg_distinct(ws):
    return ws.fact.agg(
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("category").alias("unique_categories"))


@query("agg_case_bucket", on_fact("""
SELECT CASE WHEN line_amount >= 10000 THEN '高額' WHEN line_amount >= 5000 THEN '中額'
            ELSE '少額' END AS price_rank,
       count(*) AS purchase_count, CAST(sum(line_amount) AS DOUBLE) AS total_amount
FROM fact GROUP BY 1"""))
def agg_case_bucket(ws):
    position = F.when(F.col("price_rank") == "高額", 1).when(
        F.col("price_rank") == "中額", 2).otherwise(3)
    return ws.fact.groupBy(tier(amount(), RANKS_JA, "少額").alias("price_rank")).agg(
        F.count(F.lit(1)).alias("purchase_count"), F.sum("line_amount").alias("total_amount"),
    ).orderBy(position)


@query("agg_conditional", on_fact("""
SELECT category, count(*) AS total_count,
       CAST(sum(CASE WHEN line_amount >= 10000 THEN 1 ELSE 0 END) AS BIGINT) AS high_value_count,
       round(CAST(sum(CASE WHEN line_amount >= 10000 THEN 1 ELSE 0 END) AS DOUBLE)
             / CAST(count(*) AS DOUBLE) * 100, 1) AS high_value_pct
FROM fact GROUP BY category"""))
def agg_conditional(ws):
    return ws.fact.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_count"), F.count_if(amount() >= 10000).alias("high_value_count"),
    ).withColumn("high_value_pct", share(F.col("high_value_count"), F.col("total_count"), 1))


@query("agg_nulls", on_fact("""
SELECT count(*) AS total_rows, count(src_filename) AS non_null_rows,
       count(*) - count(src_filename) AS null_rows
FROM fact"""))
def agg_nulls(ws):
    return ws.fact.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count("src_filename").alias("non_null_rows"),
        (F.count(F.lit(1)) - F.count("src_filename")).alias("null_rows"))


@query("agg_avg_having", on_fact("""
SELECT category, round(CAST(sum(line_amount) AS DOUBLE) / count(line_amount), 2) AS avg_amount,
       count(*) AS purchase_count
FROM fact GROUP BY category HAVING avg(line_amount) > 5000"""))
def agg_avg_having(ws):
    return ws.fact.groupBy("category").agg(
        mean("line_amount", 2).alias("avg_amount"), F.count(F.lit(1)).alias("purchase_count"),
        F.avg("line_amount").alias("exact"),
    ).where(F.col("exact") > 5000).drop("exact").orderBy(F.desc("avg_amount"))


@query("agg_month", on_fact("""
SELECT CAST(CAST(date_trunc('month', event_time) AS TIMESTAMP) AS VARCHAR) AS month,
       count(*) AS event_count
FROM fact GROUP BY 1"""))
def agg_month(ws):
    return ws.fact.groupBy(month_start(moment()).alias("month")).agg(
        F.count(F.lit(1)).alias("event_count")).orderBy("month")


@query("distinct_categories", on_fact("SELECT DISTINCT category FROM fact"))
def distinct_categories(ws):
    return ws.fact.select("category").distinct().orderBy("category")


@query("distinct_pairs", on_fact("SELECT DISTINCT user_id, category FROM fact"))
def distinct_pairs(ws):
    return ws.fact.select("user_id", "category").distinct()


# ---- sort, limit, subqueries ---------------------------------------------------------------


@query("sort_multi", on_fact(f"""
SELECT event_id, sku, category, {double('line_amount')} FROM fact
ORDER BY category ASC NULLS LAST, line_amount DESC NULLS LAST, event_id, sku"""))
def sort_multi(ws):
    # The tie-break makes the sort total, so a category of any size is spread over many ranges.
    return ws.fact.select("event_id", "sku", "category", "line_amount").orderBy(
        F.asc_nulls_last("category"), F.desc_nulls_last("line_amount"), "event_id", "sku")


@query("topk_recent", on_fact(f"""
SELECT event_id, sku, user_id, {text('event_time')}, {double('line_amount')} FROM fact
ORDER BY fact.event_time DESC, event_id, sku LIMIT 10"""))
def topk_recent(ws):
    return ws.fact.select("event_id", "sku", "user_id", "event_time", "line_amount").orderBy(
        F.desc("event_time"), "event_id", "sku").limit(10)


@query("topk_amount", on_fact(f"""
SELECT event_id, sku, user_id, product_name, {double('line_amount')} FROM fact
ORDER BY fact.line_amount DESC, event_id, sku LIMIT 5"""))
def topk_amount(ws):
    return ws.fact.select("event_id", "sku", "user_id", "product_name", "line_amount").orderBy(
        F.desc_nulls_last("line_amount"), "event_id", "sku").limit(5)


@query("topk_category", on_fact("""
SELECT category, CAST(total AS DOUBLE) AS total_sales
FROM (SELECT category, sum(line_amount) AS total FROM fact GROUP BY category) AS cat_sales
ORDER BY total DESC, category LIMIT 3"""))
def topk_category(ws):
    totals = ws.fact.groupBy("category").agg(F.sum("line_amount").alias("total_sales"))
    return totals.orderBy(F.desc("total_sales"), "category").limit(3)


@query("scalar_avg_diff", on_fact(f"""
SELECT event_id, sku, category, {double('line_amount')},
       (SELECT round(CAST(sum(line_amount) AS DOUBLE) / count(*), 4) FROM fact) AS global_avg,
       round(CAST(line_amount AS DOUBLE)
         - (SELECT round(CAST(sum(line_amount) AS DOUBLE) / count(*), 4) FROM fact), 4)
         AS diff_from_avg
FROM fact"""))
def scalar_avg_diff(ws):
    average = ws.fact.agg(mean("line_amount")).scalar()
    return ws.fact.select(
        "event_id", "sku", "category", "line_amount", average.alias("global_avg"),
        F.round(amount().cast("double") - average, 4).alias("diff_from_avg"))


@query("above_average", on_fact(f"""
SELECT event_id, sku, product_name, {double('line_amount')},
       (SELECT round(CAST(sum(line_amount) AS DOUBLE) / count(*), 2) FROM fact) AS overall_avg
FROM fact
WHERE CAST(line_amount AS DOUBLE) > (SELECT CAST(sum(line_amount) AS DOUBLE) / count(*) FROM fact)"""))
def above_average(ws):
    totals = ws.fact.agg(
        (F.sum("line_amount").cast("double") / F.count("line_amount")).alias("a"))
    average = totals.scalar()
    return ws.fact.where(amount().cast("double") > average).select(
        "event_id", "sku", "product_name", "line_amount", F.round(average, 2).alias("overall_avg"))


@query("max_category", on_fact("""
, cat_total AS (SELECT category, sum(line_amount) AS total FROM fact GROUP BY category)
SELECT category, CAST(total AS DOUBLE) AS total FROM cat_total
WHERE total = (SELECT max(total) FROM cat_total)""".lstrip()))
def max_category(ws):
    totals = ws.fact.groupBy("category").agg(F.sum("line_amount").alias("total"))
    return totals.where(F.col("total") == totals.agg(F.max("total")).scalar())


@query("cte_tiers", on_fact("""
, with_tier AS (
  SELECT category, line_amount,
         CASE WHEN line_amount >= 10000 THEN 'high' WHEN line_amount >= 3000 THEN 'mid'
              ELSE 'low' END AS price_tier
  FROM fact)
SELECT price_tier, category, count(*) AS transaction_count,
       CAST(sum(line_amount) AS DOUBLE) AS total_sales
FROM with_tier GROUP BY price_tier, category""".lstrip()))
def cte_tiers(ws):
    with_tier = ws.fact.select("category", "line_amount", tier(amount(), TIERS, "low").alias("price_tier"))
    return with_tier.groupBy("price_tier", "category").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("line_amount").alias("total_sales"),
    ).orderBy("price_tier", F.desc("total_sales"))


# ---- scalar functions ----------------------------------------------------------------------


@query("fn_concat", on_fact("""
SELECT event_id, sku, user_id || ' - ' || product_name AS summary,
       category || '（' || product_name || '）' AS named_category,
       'from ' || src_filename AS origin
FROM fact"""))
def fn_concat(ws):
    return ws.fact.select(
        "event_id", "sku",
        F.concat("user_id", F.lit(" - "), "product_name").alias("summary"),
        F.concat("category", F.lit("（"), "product_name", F.lit("）")).alias("named_category"),
        F.concat(F.lit("from "), "src_filename").alias("origin"))


@query("fn_lpad", on_fact("""
SELECT event_id, sku, 'u' || lpad(user_id, 6, '0') AS user_code,
       'SKU' || lpad(sku, 8, '0') AS sku_code
FROM fact"""))
def fn_lpad(ws):
    return ws.fact.select(
        "event_id", "sku",
        F.concat(F.lit("u"), F.lpad("user_id", 6, "0")).alias("user_code"),
        F.concat(F.lit("SKU"), F.lpad("sku", 8, "0")).alias("sku_code"))


@query("fn_case", on_fact(f"""
SELECT event_id, sku, category, {double('line_amount')},
       CASE WHEN line_amount >= 10000 THEN '高額' WHEN line_amount >= 3000 THEN '中額'
            ELSE '少額' END AS price_tier
FROM fact"""))
def fn_case(ws):
    return ws.fact.select("event_id", "sku", "category", "line_amount",
                          tier(amount(), TIERS_JA, "少額").alias("price_tier"))


@query("fn_iff", on_fact(f"""
SELECT event_id, sku, {double('line_amount')},
       CASE WHEN line_amount >= 5000 THEN '高額' ELSE '通常' END AS tier_iff,
       CASE WHEN line_amount >= 5000 THEN '高額' ELSE '通常' END AS tier_case
FROM fact"""))
def fn_iff(ws):
    return ws.fact.select(
        "event_id", "sku", "line_amount", iff(amount() >= 5000, "高額", "通常").alias("tier_iff"),
        F.when(amount() >= 5000, "高額").otherwise("通常").alias("tier_case"))


@query("fn_coalesce", on_star(f"""
SELECT f.event_id, f.sku, coalesce(u.user_name, 'ゲスト') AS display_name,
       CASE WHEN u.user_name IS NULL THEN 'ゲスト' ELSE u.user_name END AS display_name_v2,
       coalesce(u.prefecture, '不明') AS prefecture,
       coalesce(f.src_filename, 'unknown') AS safe_src_filename,
       coalesce(NULL, f.src_filename, u.user_name, 'none') AS first_known, {double('line_amount')}
FROM fact f LEFT JOIN users u ON u.user_id = f.user_id"""))
def fn_coalesce(ws):
    fact = ws.fact.select("event_id", "sku", "user_id", "src_filename", "line_amount")
    joined = lookup_join(fact, ws.users, "user_id", "left")
    name = F.col("user_name")
    return joined.select(
        "event_id", "sku",
        F.coalesce(name, F.lit("ゲスト")).alias("display_name"),
        F.when(name.isNull(), "ゲスト").otherwise(name).alias("display_name_v2"),
        F.coalesce("prefecture", F.lit("不明")).alias("prefecture"),
        F.nvl("src_filename", F.lit("unknown")).alias("safe_src_filename"),
        F.coalesce(F.lit(None).cast("string"), "src_filename", name, F.lit("none"))
        .alias("first_known"),
        "line_amount")


@query("fn_nullif", on_fact("""
SELECT event_id, sku, qty, nullif(qty - 10, 0) AS safe_qty,
       CASE WHEN qty = 10 THEN NULL
            ELSE round(CAST(line_amount AS DOUBLE) / (qty - 10), 4) END AS unit_price
FROM fact"""))
def fn_nullif(ws):
    over = F.col("qty") - 10
    return ws.fact.select(
        "event_id", "sku", "qty", F.nullif(over, F.lit(0)).alias("safe_qty"),
        F.round(safe_divide(amount().cast("double"), over), 4).alias("unit_price"))


@query("fn_dates", on_fact("""
SELECT event_id, sku, CAST(CAST(event_time AS DATE) AS VARCHAR) AS day,
       CAST(CAST(date_trunc('month', event_time) AS DATE) AS VARCHAR) AS month,
       CAST(CAST(event_time AS DATE) - 7 AS VARCHAR) AS week_before
FROM fact"""))
def fn_dates(ws):
    day = F.to_date("event_time")
    return ws.fact.select("event_id", "sku", day.alias("day"), F.trunc(day, "month").alias("month"),
                          F.date_sub(day, 7).alias("week_before"))


@query("fn_dateadd", on_fact("""
SELECT event_id, sku, CAST(event_time + qty * INTERVAL 1 SECOND AS VARCHAR) AS shifted
FROM fact"""))
def fn_dateadd(ws):
    return ws.fact.select(
        "event_id", "sku",
        F.timestamp_add("SECOND", F.col("qty").cast("int"), F.col("event_time")).alias("shifted"))


@query("fn_math", on_fact("""
SELECT event_id, sku, qty % 3 AS qty_mod, round(CAST(price AS DOUBLE), 1) AS price_rounded,
       power(CAST(qty AS DOUBLE), 2) AS qty_squared
FROM fact"""))
def fn_math(ws):
    return ws.fact.select(
        "event_id", "sku", (F.col("qty") % 3).alias("qty_mod"),
        F.round(F.col("price").cast("double"), 1).alias("price_rounded"),
        F.pow(F.col("qty").cast("double"), F.lit(2.0)).alias("qty_squared"))


@query("fn_cast", on_fact("""
SELECT event_id, sku, CAST(event_id AS BIGINT) AS event_number, CAST(qty AS VARCHAR) AS qty_text,
       CAST(round(line_amount) AS BIGINT) AS whole_amount,
       CAST(CAST(event_time AS DATE) AS VARCHAR) AS day,
       CAST(TRY_CAST(product_name AS BIGINT) AS BIGINT) AS not_a_number
FROM fact"""))
def fn_cast(ws):
    return ws.fact.select(
        "event_id", "sku", F.col("event_id").cast("bigint").alias("event_number"),
        F.col("qty").cast("string").alias("qty_text"),
        amount().cast("decimal(38,0)").cast("bigint").alias("whole_amount"),
        F.to_date("event_time").alias("day"),
        F.col("product_name").try_cast("bigint").alias("not_a_number"))


@query("fn_typeof", on_fact("""
SELECT 'string' AS event_id_type, 'bigint' AS qty_type, 'decimal(10,2)' AS price_type,
       'decimal(12,2)' AS line_amount_type, 'timestamp_ntz' AS event_time_type, count(*) AS row_count
FROM fact"""))
def fn_typeof(ws):
    names = ("event_id", "qty", "price", "line_amount", "event_time")
    typed = ws.fact.select(*[F.typeof(n).alias(f"{n}_type") for n in names])
    return typed.groupBy(*typed.columns).agg(F.count(F.lit(1)).alias("row_count"))


@query("fn_load_stamp", on_fact("""
SELECT src_filename, count(*) AS row_count, 1 AS stamps FROM fact GROUP BY src_filename"""))
def fn_load_stamp(ws):
    stamped = ws.fact.select("src_filename", F.localtimestamp().alias("inserted_at"))
    return stamped.groupBy("src_filename").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("inserted_at").alias("stamps"))


# ---- models --------------------------------------------------------------------------------


@query("v_sales_detail", on_detail(f"""
SELECT event_id, {text('event_time', 'purchase_date')}, year_num, month_num, day_num, user_id,
       user_name, prefecture, sku, product_name, category, qty, {double('price', 'line_amount')}
FROM detail"""))
def v_sales_detail(ws):
    return mart.v_sales_detail(ws.fact, ws.users, ws.products, ws.dates)


@query("v_category_monthly", on_detail("""
SELECT year_num, month_num, category, CAST(sum(qty) AS BIGINT) AS total_qty,
       CAST(sum(line_amount) AS DOUBLE) AS sales_amount
FROM detail GROUP BY year_num, month_num, category"""))
def v_category_monthly(ws):
    return mart.v_category_monthly_sales(v_sales_detail(ws))


@query("user_ltv", on_detail("""
SELECT user_id, user_name, prefecture, CAST(sum(line_amount) AS DOUBLE) AS lifetime_value,
       count(DISTINCT event_id) AS purchase_count
FROM detail GROUP BY user_id, user_name, prefecture"""))
def user_ltv(ws):
    return mart.v_user_ltv(v_sales_detail(ws))


@query("v_high_value", on_fact(f"""
SELECT event_id, user_id, category, product_name, {double('line_amount')}
FROM fact WHERE line_amount >= 5000"""))
def v_high_value(ws):
    return mart.v_high_value_orders(ws.fact)


@query("category_summary", on_fact("""
SELECT category, count(*) AS item_count, CAST(sum(line_amount) AS DOUBLE) AS total_amount,
       round(CAST(avg(line_amount) AS DOUBLE), 4) AS avg_amount
FROM fact GROUP BY category"""))
def category_summary(ws):
    return mart.category_summary(ws.fact).withColumn(
        "avg_amount", F.round(F.col("avg_amount").cast("double"), 4))


@query("fct_purchase_events", on_fact(f"""
SELECT event_id, user_id, {text('event_time')}, sku, product_name, category, qty,
       {double('price', 'line_amount')}, src_filename
FROM fact"""))
def fct_purchase_events(ws):
    return mart.fact_purchase_events(ws.event_items)


@query("fact_order_lines", """
SELECT o_orderkey AS order_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
       o_custkey AS user_id, l_partkey AS sku, CAST(l_quantity AS BIGINT) AS qty,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
       CAST(CAST(CAST(l_quantity AS BIGINT) * CAST(l_extendedprice AS DECIMAL(10,2))
            AS DECIMAL(12,2)) AS DOUBLE) AS line_amount
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def fact_order_lines(ws):
    return mart.fact_order_lines(*normalised_orders(ws))


def normalised_orders(ws):
    """Orders and their items in the normalised column names."""
    orders = ws.source("orders").select(
        F.col("o_orderkey").alias("order_id"), F.to_date("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("user_id"))
    items = ws.source("lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"))
    return orders, items


@query("dim_users", with_ctes(USERS, select="SELECT user_id, user_name, prefecture FROM users"))
def dim_users(ws):
    return ws.users


@query("dim_users_from_fact", on_fact("""
SELECT DISTINCT user_id,
       CASE WHEN user_id = '1' THEN 'Aki' WHEN user_id = '2' THEN 'Mina' ELSE 'Unknown' END
         AS user_name,
       CASE WHEN user_id = '1' THEN 'Tokyo' WHEN user_id = '2' THEN 'Osaka' ELSE 'Unknown' END
         AS prefecture
FROM fact"""))
def dim_users_from_fact(ws):
    return mart.dim_users_named(ws.fact, {"1": ("Aki", "Tokyo"), "2": ("Mina", "Osaka")})


@query("dim_products", on_fact("SELECT DISTINCT sku, product_name, category FROM fact"))
def dim_products(ws):
    return mart.dim_products(ws.fact)


@query("dim_products_latest", on_fact("""
SELECT sku, product_name, category FROM (
  SELECT *, row_number() OVER (PARTITION BY sku ORDER BY event_time DESC, event_id DESC) AS n
  FROM fact) AS numbered
WHERE n = 1"""))
def dim_products_latest(ws):
    return mart.dim_products_latest(ws.fact)


@query("dim_date", on_star(f"SELECT {text('date_key')}, year_num, month_num, day_num FROM dates"))
def dim_date(ws):
    return mart.dim_date(ws.fact)


@query("df_sales_by_category", on_fact("""
SELECT category, CAST(sum(line_amount) AS DOUBLE) AS total_sales, count(*) AS transaction_count
FROM fact GROUP BY category"""))
def df_sales_by_category(ws):
    return ws.fact.groupBy("category").agg(
        F.sum("line_amount").alias("total_sales"), F.count("*").alias("transaction_count"),
    ).sort(F.col("total_sales").desc())
