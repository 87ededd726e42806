"""Semi-structured events: typed paths, flattening and nesting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.ordered import Key, running
from martlet.sizing import limit

MONEY = "decimal(10,2)"
AMOUNT = "decimal(12,2)"


def path(source: str | Column, where: str, as_type: str = "string") -> Column:
    """Value at a JSON path as ``as_type``; missing paths and wrong shapes give NULL."""
    return F.try_variant_get(F.col(source) if isinstance(source, str) else source, f"$.{where}", as_type)


def event_time(raw: str = "raw") -> Column:
    return F.to_timestamp_ntz(path(raw, "event_time"))


def header_columns(raw: str = "raw") -> list[Column]:
    """The typed header of one event."""
    return [
        path(raw, "event_id").alias("event_id"),
        path(raw, "user_id").alias("user_id"),
        path(raw, "event_type").alias("event_type"),
        path(raw, "device.os").alias("device_os"),
        path(raw, "device.app_version").alias("app_version"),
        path(raw, "review_text").alias("review_text"),
        event_time(raw).alias("event_time"),
    ]


def flatten(df: DataFrame, where: str, raw: str = "raw") -> DataFrame:
    """One row per element of the array or object at ``where``, with ``pos``, ``key``, ``value``.

    Rows whose path is missing or empty disappear.
    """
    return _elements(df, path(F.col(raw).outer(), where, "variant"))


def _elements(df: DataFrame, array: Column) -> DataFrame:
    return df.lateralJoin(df.sparkSession.tvf.variant_explode(array))


def flatten_variant(df: DataFrame, column: str) -> DataFrame:
    """The same for a variant column that is the array or object itself; the column is left out."""
    return _elements(df, F.col(column).outer()).drop(column)


def flatten_with_meta(
    df: DataFrame, row_key: str, where: str, raw: str = "raw", keep: Sequence[str] = (),
    offset: Column | None = None,
) -> DataFrame:
    """Flatten with the bookkeeping columns SEQ, KEY, PATH, INDEX, VALUE and THIS.

    ``keep`` are further columns of the input. THIS repeats the whole array on every element, so what
    is derived from it is better computed before flattening and kept.

    SEQ identifies the input row. It is a hash of the row's key, so it needs no numbering pass over
    the table and stays the same when a task is retried.
    """
    flat = flatten(df, where, raw)
    if offset is not None:  # elements of the same key in earlier documents; INDEX and PATH go on from there
        flat = flat.withColumn("pos", (F.col("pos") + offset).cast("int"))
    is_element = F.col("key").isNull()
    return flat.select(
        F.col(row_key),
        *keep,
        F.xxhash64(row_key).alias("seq"),
        F.col("key"),
        F.when(is_element, F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        .otherwise(F.col("key"))
        .alias("path"),
        F.when(is_element, F.col("pos")).alias("index"),
        F.col("value"),
        path(raw, where, "variant").alias("this"),
    )


def item_columns(item: str = "value") -> list[Column]:
    """The typed columns of one purchased item, with its amount."""
    qty = path(item, "qty", "decimal(38,0)").cast("bigint")
    price = path(item, "price", MONEY)
    return [
        path(item, "sku").alias("sku"),
        path(item, "product_name").alias("product_name"),
        path(item, "category").alias("category"),
        qty.alias("qty"),
        price.alias("price"),
        (qty * price).cast(AMOUNT).alias("line_amount"),
    ]


def nest(
    df: DataFrame,
    keys: Sequence[str],
    item_fields: Sequence[str],
    order: Sequence[Key],
    carry: dict[str, Column] | None = None,
    items: str = "items",
    max_items: int | None = None,
    part: str | None = None,
    rows_per_segment: int | None = None,
) -> DataFrame:
    """Relational rows back to one document per key: the inverse of flatten.

    A document holds at most ``max_items`` items (by default the session's limit); a key with more
    continues in further documents, so no task ever gathers an unbounded group. ``part`` names a column
    for a document's number within its key, from 0. ``carry`` are aggregates kept beside the items.
    """
    max_items = max_items or limit(df.sparkSession, "documentItems")
    numbered = running(df, keys, order, number="line_no", rows_per_segment=rows_per_segment)
    number = F.floor((F.col("line_no") - 1) / max_items).cast("bigint")
    gathered = (
        numbered.withColumn("_part", number)
        .groupBy(*keys, "_part")
        .agg(
            F.array_sort(F.collect_list(F.struct("line_no", *item_fields))).alias(items),
            *[expression.alias(name) for name, expression in (carry or {}).items()],
        )
    )
    return gathered.withColumnRenamed("_part", part) if part else gathered.drop("_part")
