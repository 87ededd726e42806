"""Exact distinct counts that can be merged: bitmaps over a dense numbering of the counted values.

Each value gets a number once; new values go on behind the last one. A rollup holds, for each group of
its dimensions and each range of numbers, the bitmap of the numbers that occur. Any coarser count is an OR
of bitmaps, so rows are neither expanded nor shuffled by value again, and rollups of later batches are merged
into earlier ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.ordered import asc, running
from martlet.sizing import lookup_join, stored

NUMBER, RANGE, BITS = "_number", "_range", "_bits"


def number_values(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(column, _number) of all values: ``known`` as they are, new ones numbered on from the last, in order."""
    new = values.select(column).where(F.col(column).isNotNull()).distinct()
    start = F.lit(0).cast("long")
    if known is not None:
        new = new.join(known.select(column), column, "left_anti")
        start = known.agg(F.coalesce(F.max(NUMBER), F.lit(0))).scalar()
    # Stored: numbering a large list reads it several times.
    numbered = running(stored(new), [], asc(column), number=NUMBER).select(column, (F.col(NUMBER) + start).alias(NUMBER))
    return numbered if known is None else known.select(column, NUMBER).unionByName(numbered)


def rollup(rows: DataFrame, by: Sequence[str | Column], column: str, numbers: DataFrame) -> DataFrame:
    """Bitmaps of the numbers of ``column`` for each group of ``by``; a NULL value is not counted."""
    numbered = lookup_join(rows, numbers, column)
    return numbered.groupBy(*by, F.bitmap_bucket_number(NUMBER).alias(RANGE)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias(BITS))


def merged(rollups: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """A rollup by fewer dimensions, or of several batches."""
    return rollups.groupBy(*by, RANGE).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(rollups: DataFrame, by: Sequence[str | Column], name: str) -> DataFrame:
    """Number of distinct values for each group of ``by``: one OR for each range of numbers, and a sum."""
    ranges = merged(rollups, by)
    keys = [c for c in ranges.columns if c not in (RANGE, BITS)]
    return ranges.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).alias(name))
