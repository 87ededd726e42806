"""Window queries on the purchase fact.

Rows are ordered by the stated column and then by (event_id, sku), so that numbering, neighbours and
running sums do not depend on how equal rows happen to arrive.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from martlet.functions.scalar import month_start, share
from martlet.operators.ordered import Key, asc, desc, framed, place, ranked, running
from martlet.plans.oracle import double, on_fact, on_star, text
from martlet.plans.registry import query
from martlet.sizing import lookup_join, stored, with_totals
from martlet.sources import tables

BY_AMOUNT = [*desc("line_amount"), *asc("event_id", "sku")]
BY_TIME = asc("event_time", "event_id", "sku")
LINE = ("event_id", "sku", "category", "line_amount")
SQL_BY_AMOUNT = "ORDER BY line_amount DESC, event_id, sku"
SQL_BY_TIME = "ORDER BY fact.event_time, event_id, sku"


@query("win_grand_total", on_fact(f"""
SELECT event_id, sku, category, {double('line_amount')},
       CAST(sum(line_amount) OVER () AS DOUBLE) AS grand_total
FROM fact"""))
def win_grand_total(ws):
    return with_totals(ws.fact.select(*LINE), [], {"grand_total": F.sum("line_amount")})


@query("win_share", on_fact(f"""
SELECT event_id, sku, category, {double('line_amount')},
       CAST(sum(line_amount) OVER () AS DOUBLE) AS grand_total,
       CAST(sum(line_amount) OVER (PARTITION BY category) AS DOUBLE) AS category_total,
       round(CAST(line_amount AS DOUBLE)
         / CAST(sum(line_amount) OVER (PARTITION BY category) AS DOUBLE) * 100, 2)
         AS share_in_category
FROM fact"""))
def win_share(ws):
    fact = with_totals(ws.fact.select(*LINE), [], {"grand_total": F.sum("line_amount")})
    fact = with_totals(fact, ["category"], {"category_total": F.sum("line_amount")})
    return fact.withColumn(
        "share_in_category", share(F.col("line_amount"), F.col("category_total"), 2))


@query("win_rownum_topk", on_fact(f"""
SELECT * FROM (
  SELECT event_id, sku, category, {double('line_amount')},
         row_number() OVER ({SQL_BY_AMOUNT}) AS overall_rank
  FROM fact) AS numbered
WHERE overall_rank <= 10"""))
def win_rownum_topk(ws, k=10):
    # Only the k first rows are numbered; the full table is never put in one order.
    first = ws.fact.select(*LINE).orderBy(*[item.sort for item in BY_AMOUNT]).limit(k)
    return running(first, [], BY_AMOUNT, number="overall_rank")


@query("win_rownum_part", on_fact(f"""
SELECT event_id, sku, category, {double('line_amount')},
       row_number() OVER (PARTITION BY category {SQL_BY_AMOUNT}) AS rank_in_category
FROM fact"""))
def win_rownum_part(ws):
    return running(ws.fact.select(*LINE), ["category"], BY_AMOUNT, number="rank_in_category")


@query("win_ranks", on_fact(f"""
SELECT event_id, sku, category, {double('line_amount')},
       rank() OVER (PARTITION BY category ORDER BY line_amount DESC) AS rank_with_gap,
       dense_rank() OVER (PARTITION BY category ORDER BY line_amount DESC) AS rank_dense
FROM fact"""))
def win_ranks(ws):
    return ranked(ws.fact.select(*LINE), ["category"], Key("line_amount", True),
                  asc("event_id", "sku"), "rank_with_gap", "rank_dense")


@query("win_running_user", on_fact(f"""
SELECT user_id, event_id, sku, {text('event_time')}, {double('line_amount')},
       CAST(sum(line_amount) OVER (PARTITION BY user_id {SQL_BY_TIME}
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumulative_amount
FROM fact"""))
def win_running_user(ws):
    fact = ws.fact.select("user_id", "event_id", "sku", "event_time", "line_amount")
    return running(fact, ["user_id"], BY_TIME, {"cumulative_amount": F.col("line_amount")})


@query("win_running_global", on_fact(f"""
SELECT event_id, sku, {text('event_time')}, {double('line_amount')},
       CAST(sum(line_amount) OVER ({SQL_BY_TIME}
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM fact"""))
def win_running_global(ws):
    fact = ws.fact.select("event_id", "sku", "event_time", "line_amount")
    return running(fact, [], BY_TIME, {"running_total": F.col("line_amount")})


@query("win_lag_lead", on_fact(f"""
SELECT user_id, event_id, sku, {text('event_time')}, {double('line_amount')},
       CAST(lag(line_amount) OVER w AS DOUBLE) AS prev_amount,
       CAST(lead(line_amount) OVER w AS DOUBLE) AS next_amount,
       CAST(line_amount - lag(line_amount) OVER w AS DOUBLE) AS diff_from_prev
FROM fact WINDOW w AS (PARTITION BY user_id {SQL_BY_TIME})"""))
def win_lag_lead(ws):
    fact = ws.fact.select("user_id", "event_id", "sku", "event_time", "line_amount")
    return framed(fact, ["user_id"], BY_TIME, 1, 1, lambda w: {
        "prev_amount": F.lag("line_amount").over(w),
        "next_amount": F.lead("line_amount").over(w),
        "diff_from_prev": F.col("line_amount") - F.lag("line_amount").over(w),
    })


@query("win_lag_default", on_fact(f"""
SELECT user_id, event_id, sku, {text('event_time')}, {double('line_amount')},
       CAST(lag(line_amount, 1, 0) OVER w AS DOUBLE) AS prev_amount,
       CAST(line_amount - lag(line_amount, 1, 0) OVER w AS DOUBLE) AS diff
FROM fact WINDOW w AS (PARTITION BY user_id {SQL_BY_TIME})"""))
def win_lag_default(ws):
    fact = ws.fact.select("user_id", "event_id", "sku", "event_time", "line_amount")
    return framed(fact, ["user_id"], BY_TIME, 1, 0, lambda w: {
        "prev_amount": F.lag("line_amount", 1, 0).over(w),
        "diff": F.col("line_amount") - F.lag("line_amount", 1, 0).over(w),
    })


@query("win_moving_avg", on_fact(f"""
SELECT user_id, event_id, sku, {text('event_time')}, {double('line_amount')},
       round(CAST(sum(line_amount) OVER w AS DOUBLE) / count(*) OVER w, 4) AS moving_avg
FROM fact
WINDOW w AS (PARTITION BY user_id {SQL_BY_TIME} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""))
def win_moving_avg(ws, back=2):
    fact = ws.fact.select("user_id", "event_id", "sku", "event_time", "line_amount")

    def columns(w):
        frame = w.rowsBetween(-back, 0)
        total = F.sum("line_amount").over(frame).cast("double")
        return {"moving_avg": F.round(total / F.count("line_amount").over(frame), 4)}

    return framed(fact, ["user_id"], BY_TIME, back, 0, columns)


@query("win_top1", on_fact(f"""
SELECT event_id, sku, category, product_name, {double('line_amount')} FROM (
  SELECT *, row_number() OVER (PARTITION BY category {SQL_BY_AMOUNT}) AS rn FROM fact) AS fact
WHERE rn = 1"""))
def win_top1(ws):
    # The best row of a key is an aggregate: one candidate per key leaves each task.
    best = F.min_by(
        F.struct("event_id", "sku", "product_name", "line_amount"), place(BY_AMOUNT)).alias("best")
    return ws.fact.groupBy("category").agg(best).select(
        "best.event_id", "best.sku", "category", "best.product_name", "best.line_amount")


@query("win_rank1", on_fact(f"""
SELECT category, event_id, sku, product_name, {double('line_amount')}, rank FROM (
  SELECT *, rank() OVER (PARTITION BY category ORDER BY line_amount DESC) AS rank FROM fact) AS fact
WHERE rank = 1"""))
def win_rank1(ws):
    # Rank 1 keeps every row tied for the maximum, so join the maximum back instead of sorting.
    fact = ws.fact.select("category", "event_id", "sku", "product_name", "line_amount")
    return (
        with_totals(fact, ["category"], {"_top": F.max("line_amount")})
        .where(F.col("line_amount").eqNullSafe(F.col("_top")))
        .drop("_top").withColumn("rank", F.lit(1))
    )


@query("win_topn_part", on_fact(f"""
SELECT event_id, sku, category, {double('line_amount')}, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY category {SQL_BY_AMOUNT}) AS rn FROM fact) AS fact
WHERE rn <= 3"""))
def win_topn_part(ws, n=3):
    # Spark applies the row_number filter before the shuffle as well (WindowGroupLimit), so each
    # task sends at most n rows per category.
    spec = W.partitionBy("category").orderBy(*[item.sort for item in BY_AMOUNT])
    return ws.fact.select(*LINE).withColumn("rn", F.row_number().over(spec)).where(
        F.col("rn") <= n)


@query("win_cum_share", on_fact(f"""
SELECT event_id, sku, category, {double('line_amount')},
       CAST(sum(line_amount) OVER w AS DOUBLE) AS cumulative_in_cat,
       round(CAST(sum(line_amount) OVER w AS DOUBLE)
         / CAST(sum(line_amount) OVER (PARTITION BY category) AS DOUBLE) * 100, 1)
         AS cumulative_share_pct
FROM fact
WINDOW w AS (PARTITION BY category {SQL_BY_AMOUNT}
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def win_cum_share(ws):
    fact = running(ws.fact.select(*LINE), ["category"], BY_AMOUNT,
                   {"cumulative_in_cat": F.col("line_amount")})
    fact = with_totals(fact, ["category"], {"_total": F.sum("line_amount")}, of=ws.fact)
    return fact.withColumn(
        "cumulative_share_pct", share(F.col("cumulative_in_cat"), F.col("_total"), 1)
    ).drop("_total")


@query("win_month_rank", on_fact("""
, monthly AS (
  SELECT date_trunc('month', event_time) AS sale_month, category, sum(line_amount) AS monthly_total
  FROM fact GROUP BY 1, 2)
SELECT CAST(CAST(sale_month AS TIMESTAMP) AS VARCHAR) AS sale_month, category,
       CAST(monthly_total AS DOUBLE) AS monthly_total, rank_in_month
FROM (SELECT *, rank() OVER (PARTITION BY sale_month ORDER BY monthly_total DESC) AS rank_in_month
      FROM monthly) AS numbered
WHERE rank_in_month <= 3"""))
def win_month_rank(ws, top=3):
    monthly = ws.fact.groupBy(month_start(F.col("event_time")).alias("sale_month"), "category").agg(
        F.sum("line_amount").alias("monthly_total"))
    spec = W.partitionBy("sale_month").orderBy(F.desc("monthly_total"))
    return monthly.withColumn("rank_in_month", F.rank().over(spec)).where(
        F.col("rank_in_month") <= top).orderBy("sale_month", "rank_in_month")


@query("win_user_pct", on_star("""
, summary AS (
  SELECT user_id, category, count(*) AS purchase_count, sum(line_amount) AS total_amount
  FROM fact GROUP BY user_id, category)
SELECT s.user_id, u.user_name, u.prefecture, s.category, s.purchase_count,
       CAST(s.total_amount AS DOUBLE) AS total_amount,
       round(CAST(s.total_amount AS DOUBLE)
         / CAST(sum(s.total_amount) OVER (PARTITION BY s.user_id) AS DOUBLE) * 100, 1)
         AS pct_of_user_total
FROM summary s JOIN users u ON u.user_id = s.user_id"""))
def win_user_pct(ws):
    # The summary is a temporary table of the session: computed once, read twice, in SQL by its name.
    name = f"user_summary_{ws.digest}"
    summary = tables.temporary_table(ws.fact.groupBy("user_id", "category").agg(
        F.count(F.lit(1)).alias("purchase_count"), F.sum("line_amount").alias("total_amount")), name)
    named = lookup_join(summary, ws.users, "user_id")
    totals = ws.spark.sql(f"SELECT user_id, sum(total_amount) AS _total FROM {name} GROUP BY user_id")
    return named.join(totals, "user_id").select(
        "user_id", "user_name", "prefecture", "category", "purchase_count", "total_amount",
        share(F.col("total_amount"), F.col("_total"), 1).alias("pct_of_user_total"))


@query("top_users_named", on_star("""
, totals AS (SELECT user_id, sum(line_amount) AS total FROM fact GROUP BY user_id),
named AS (SELECT t.user_id, u.user_name, t.total FROM totals t JOIN users u ON u.user_id = t.user_id)
SELECT user_id, user_name, CAST(total AS DOUBLE) AS total_amount, rank
FROM (SELECT *, rank() OVER (ORDER BY total DESC) AS rank FROM named) AS numbered
WHERE rank <= 3"""))
def top_users_named(ws, top=3):
    totals = ws.fact.groupBy("user_id").agg(F.sum("line_amount").alias("total_amount"))
    named = stored(totals.join(ws.users.select("user_id", "user_name"), "user_id"))
    # Rank over the whole table without a key: a rank is decided by the top distinct totals, so
    # rank those and join the few that qualify.
    counts = named.groupBy("total_amount").agg(F.count(F.lit(1)).alias("_n"))
    best = running(counts.orderBy(F.desc("total_amount")).limit(top), [], desc("total_amount"),
                   {"_to_here": F.col("_n")})
    best = best.select("total_amount", (F.col("_to_here") - F.col("_n") + 1).alias("rank")).where(
        F.col("rank") <= top)
    return named.join(F.broadcast(best), "total_amount").select(
        "user_id", "user_name", "total_amount", "rank")


@query("top_user", on_fact("""
SELECT user_id, CAST(total AS DOUBLE) AS total_amount
FROM (SELECT user_id, sum(line_amount) AS total FROM fact GROUP BY user_id) AS totals
ORDER BY total DESC, user_id LIMIT 1"""))
def top_user(ws):
    return ws.fact.groupBy("user_id").agg(F.sum("line_amount").alias("total_amount")).orderBy(
        F.desc("total_amount"), "user_id").limit(1)
