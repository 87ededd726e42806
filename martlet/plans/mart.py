"""Models of the three layers: RAW documents, STAGING rows, MART facts, dimensions and views.

Every function takes and returns DataFrames; only ``lookup_join`` counts its small side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.operators.ordered import latest_of_copies, latest_per_key
from martlet.operators.variant import event_time, flatten_variant, header_columns, item_columns, path
from martlet.sizing import lookup_join

FACT_KEY = ("event_id", "sku")
FACT_COLUMNS = (
    "event_id", "user_id", "event_time", "sku", "product_name", "category",
    "qty", "price", "line_amount", "src_filename",
)
# Which copy of a fact row wins when several were loaded: the newest load, then the later file,
# then the later position in its document.
NEWEST_LOAD = ("loaded_at", "src_filename", "line_no")


def raw_events(documents: DataFrame) -> DataFrame:
    """Landed JSON text as a variant beside its load metadata."""
    return documents.select(F.parse_json("line").alias("raw"), "src_filename", "loaded_at")


def headers(raw: DataFrame) -> DataFrame:
    """One document per landed event: the first, where a large event is delivered in several."""
    return raw.where(F.coalesce(path("raw", "part", "bigint"), F.lit(0)) == 0)


def stg_events(raw: DataFrame) -> DataFrame:
    """One typed header row per landed event."""
    return headers(raw).select(*header_columns(), "src_filename", "loaded_at")


def stg_events_latest(raw: DataFrame) -> DataFrame:
    """One header row per event id: the newest load, then the later file name."""
    staged = stg_events(raw)
    return latest_per_key(staged, ["event_id"], ["loaded_at", "src_filename"])


def dyn_stg_events(raw: DataFrame) -> DataFrame:
    """The continuously refreshed staging table: device stays JSON text."""
    return headers(raw).select(
        path("raw", "event_id").alias("event_id"),
        path("raw", "user_id").alias("user_id"),
        path("raw", "event_type").alias("event_type"),
        event_time().alias("event_time"),
        path("raw", "device").alias("device"),
        "src_filename", "loaded_at",
    )


def stg_event_items(raw: DataFrame) -> DataFrame:
    """One row per purchased item. Copies from reloads are kept, as in the RAW layer.

    The header is read once for each document, and only the items themselves go through the generator.
    """
    heads = raw.select(
        path("raw", "event_id").alias("event_id"),
        path("raw", "user_id").alias("user_id"),
        path("raw", "event_time").alias("event_time"),
        path("raw", "items", "variant").alias("items"),
        "src_filename", "loaded_at",
    )
    return flatten_variant(heads, "items").select(
        "event_id", "user_id",
        F.to_timestamp_ntz("event_time").alias("event_time"),
        *item_columns(),
        F.coalesce(path("value", "line_no", "bigint"), F.col("pos").cast("bigint")).alias("line_no"),
        "src_filename", "loaded_at",
    )


def merge_source(items: DataFrame) -> DataFrame:
    """One row per fact key, so that a batch holding two copies cannot insert both."""
    return latest_per_key(items, FACT_KEY, NEWEST_LOAD)


def merge_stored(items: DataFrame) -> DataFrame:
    """``merge_source`` of a stored table, which may be read twice: only rows whose key has copies are shuffled."""
    return latest_of_copies(items, FACT_KEY, NEWEST_LOAD)


def fact_purchase_events(items: DataFrame) -> DataFrame:
    return merge_source(items).select(*FACT_COLUMNS)


def fact_order_lines(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Order lines with their amount, from the normalised tables."""
    return orders.join(order_items, "order_id").select(
        "order_id", "order_date", "user_id", "sku", "qty", "price",
        (F.col("qty") * F.col("price")).cast("decimal(12,2)").alias("line_amount"),
    )


def dim_users_named(fact: DataFrame, names: dict[str, tuple[str, str]]) -> DataFrame:
    """Users seen in the fact; ``names`` maps a user id to (user_name, prefecture)."""
    name, prefecture = F.lit("Unknown"), F.lit("Unknown")
    for user_id, (user_name, place) in names.items():
        name = F.when(F.col("user_id") == user_id, user_name).otherwise(name)
        prefecture = F.when(F.col("user_id") == user_id, place).otherwise(prefecture)
    return fact.select("user_id").distinct().select(
        "user_id", name.alias("user_name"), prefecture.alias("prefecture")
    )


def dim_products(fact: DataFrame) -> DataFrame:
    """Distinct products; unique per sku as long as names never change (see quality checks)."""
    return fact.select("sku", "product_name", "category").distinct()


def dim_products_latest(fact: DataFrame) -> DataFrame:
    """One row per sku even when names drift: the attributes of its latest event."""
    return latest_per_key(
        fact.select("sku", "product_name", "category", "event_time", "event_id"),
        ["sku"], ["event_time", "event_id"],
    ).select("sku", "product_name", "category")


def dim_date(fact: DataFrame) -> DataFrame:
    day = fact.select(F.to_date("event_time").alias("date_key")).distinct()
    return day.select(
        "date_key",
        F.year("date_key").alias("year_num"),
        F.month("date_key").alias("month_num"),
        F.dayofmonth("date_key").alias("day_num"),
    )


def v_sales_detail(
    fact: DataFrame, users: DataFrame, products: DataFrame, dates: DataFrame
) -> DataFrame:
    """Fact with all dimension attributes. Name and category come from the product dimension."""
    detail = fact.drop("product_name", "category").withColumn(
        "purchase_date", F.to_date("event_time")
    )
    detail = lookup_join(detail, users, "user_id")
    detail = lookup_join(detail, products, "sku")
    detail = lookup_join(detail, dates, F.col("purchase_date") == F.col("date_key"))
    return detail.select(
        "event_id", "event_time", "purchase_date", "year_num", "month_num", "day_num",
        "user_id", "user_name", "prefecture", "sku", "product_name", "category",
        "qty", "price", "line_amount",
    )


def v_category_monthly_sales(detail: DataFrame) -> DataFrame:
    return detail.groupBy("year_num", "month_num", "category").agg(
        F.sum("qty").alias("total_qty"), F.sum("line_amount").alias("sales_amount")
    )


def v_sales_public(detail: DataFrame) -> DataFrame:
    """The columns that may leave the house; publish by writing this projection to a table."""
    return detail.select("purchase_date", "prefecture", "category", "qty", "line_amount")


def shared_fact(fact: DataFrame) -> DataFrame:
    """The fact without the buyer, for sharing at row level."""
    return fact.select("event_id", "event_time", "sku", "category", "qty", "line_amount")


def v_user_ltv(detail: DataFrame) -> DataFrame:
    return detail.groupBy("user_id", "user_name", "prefecture").agg(
        F.sum("line_amount").alias("lifetime_value"),
        F.count_distinct("event_id").alias("purchase_count"),
    )


def v_high_value_orders(fact: DataFrame, at_least: int = 5000) -> DataFrame:
    return fact.where(F.col("line_amount") >= at_least).select(
        "event_id", "user_id", "category", "product_name", "line_amount"
    )


def category_summary(fact: DataFrame) -> DataFrame:
    return fact.groupBy("category").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("line_amount").alias("total_amount"),
        F.avg("line_amount").alias("avg_amount"),
    )
