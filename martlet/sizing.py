"""Decisions that depend on measured sizes: what may be broadcast, how far to split or spread.

The limits can be set per session: ``spark.martlet.broadcastRows``, ``spark.martlet.broadcastBytes``,
``spark.martlet.segmentRows`` ``spark.martlet.fileRows`` and ``spark.martlet.documentItems``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.session import shared_folder

LIMITS = {
    # A lookup side with more rows or bytes than this is joined by shuffle; adaptive execution then
    # splits the partitions a hot key overfills.
    "broadcastRows": 500_000,
    "broadcastBytes": 256 * 1024 * 1024,
    # Rows one task should sort at most when an ordered computation is split into segments.
    "segmentRows": 8_000_000,
    # Rows of a shuffle that one task gathers or sorts in memory, whatever the session's number of partitions.
    "taskRows": 500_000,
    # Rows per output file of a clustered write (about 128-256 MB of fact rows).
    "fileRows": 4_000_000,
    # Keys that are looked up one by one in a table, by its buckets and row groups.
    "lookupKeys": 1_000,
    # Items of one JSON document; a larger event is delivered in several documents.
    "documentItems": 1_000,
}

_FIXED_WIDTH = (
    T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def limit(spark: SparkSession, name: str) -> int:
    return int(spark.conf.get(f"spark.martlet.{name}", str(LIMITS[name])))


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def _width(field: T.StructField) -> Column:
    if isinstance(field.dataType, _FIXED_WIDTH):
        return F.lit(16)
    return F.coalesce(F.octet_length(F.col(f"`{field.name}`").cast("string")), F.lit(0)) + 16


def small_enough(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether ``df`` may be broadcast: its rows and bytes are counted, not estimated.

    One aggregate over a side that would otherwise be shuffled whole.
    """
    spark = df.sparkSession
    width = sum((_width(f) for f in df.schema.fields), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    allowed = limit(spark, "broadcastRows") if max_rows is None else max_rows
    return rows <= allowed and size <= limit(spark, "broadcastBytes")


def lookup_join(
    left: DataFrame, lookup: DataFrame, on, how: str = "inner", max_rows: int | None = None
) -> DataFrame:
    """Join ``left`` to a side that is usually small, broadcasting it only when it is."""
    return left.join(F.broadcast(lookup) if small_enough(lookup, max_rows) else lookup, on, how)


def with_totals(
    df: DataFrame,
    keys: Sequence[str],
    totals: dict[str, Column],
    max_rows: int | None = None,
    of: DataFrame | None = None,
) -> DataFrame:
    """Put per-key totals on every row without moving a key's rows into one task.

    ``sum(x) over (partition by k)`` would shuffle all rows of a key together. Here the totals are
    aggregated first (partial sums before the shuffle), stored, and joined back; NULL is a key like
    any other. ``of`` is what to aggregate where that is simpler than ``df`` itself.
    """
    of = df if of is None else of
    if not keys:
        for name, expression in totals.items():
            df = df.withColumn(name, of.agg(expression.alias(name)).scalar())
        return df
    per_key = stored(of.groupBy(*keys).agg(*[e.alias(n) for n, e in totals.items()]))
    for key in keys:
        per_key = per_key.withColumnRenamed(key, f"_total_{key}")
    same = F.lit(True)
    for key in keys:
        same = same & df[key].eqNullSafe(F.col(f"_total_{key}"))
    return lookup_join(df, per_key, same, "inner", max_rows).drop(*[f"_total_{k}" for k in keys])


def segment_count(rows: int, rows_per_segment: int) -> int:
    return max(1, math.ceil(rows / rows_per_segment))


def tasks_for(df: DataFrame) -> int:
    """Partitions of a shuffle of ``df``'s rows, so that a task's share stays in memory at any size."""
    spark = df.sparkSession
    return max(spark.sparkContext.defaultParallelism, segment_count(df.count(), limit(spark, "taskRows")))


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for work that is heavy per row, such as tokenising.

    A small file is one row group and so one task, however long its texts are. Only an input with
    fewer splits than cores is redistributed; a large one already has far more and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() <= cores else df
