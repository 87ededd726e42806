"""Synthetic purchase events, one per input row, reproducible for a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of generated events.
CATEGORIES = ("Sports", "Food", "Home", "Electronics", "Fashion")
SYSTEMS = ("iOS", "Android", "PC")
START = "2025-12-01 00:00:00"
SPAN_SECONDS = 7_776_000
USERS, SKUS, MAX_QTY = 30, 100, 3
MIN_PRICE, MAX_PRICE = 100, 9999


def uniform(low: int, high: int, sequence: Column, seed: int, use: str) -> Column:
    """Whole number in [low, high] from 52 bits of an MD5 of the sequence number: the same on every
    retry, for every partitioning and on other engines, unlike ``rand``."""
    text = F.concat_ws("|", sequence.cast("string"), F.lit(str(seed)), F.lit(use))
    drawn = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") % (high - low + 1)
    return (drawn + low).cast("int")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def generate_events(sequence: DataFrame, column: str = "id", seed: int = 42) -> DataFrame:
    """RAW rows (``raw``, ``src_filename``, ``loaded_at``) with one item each."""
    n = F.col(column)
    sku = uniform(1, SKUS, n, seed, "sku")
    code = F.lpad(sku.cast("string"), 4, "0")
    moment = F.timestamp_add(
        "SECOND", uniform(0, SPAN_SECONDS, n, seed, "time"), F.lit(START).cast("timestamp_ntz"))
    document = F.to_json(F.struct(
        F.concat(F.lit("gen_"), n.cast("string")).alias("event_id"),
        F.concat(F.lit("u"), F.lpad(uniform(1, USERS, n, seed, "user").cast("string"), 3, "0"))
        .alias("user_id"),
        F.lit("purchase").alias("event_type"),
        F.concat(F.translate(moment.cast("string"), " ", "T"), F.lit("Z")).alias("event_time"),
        F.struct(_pick(SYSTEMS, n % 3).alias("os"), F.lit("2.0.0").alias("app_version"))
        .alias("device"),
        F.array(F.struct(
            F.concat(F.lit("SKU"), code).alias("sku"),
            F.concat(F.lit("Product_"), code).alias("product_name"),
            _pick(CATEGORIES, (sku - 1) % 5).alias("category"),
            uniform(1, MAX_QTY, n, seed, "qty").alias("qty"),
            uniform(MIN_PRICE, MAX_PRICE, n, seed, "price").alias("price"),
        )).alias("items"),
    ))
    return sequence.select(
        F.parse_json(document).alias("raw"),
        F.lit("generated").alias("src_filename"),
        F.localtimestamp().alias("loaded_at"),
    )
