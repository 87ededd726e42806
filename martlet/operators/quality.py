"""Data-quality checks. Each returns a DataFrame of findings or counts; empty findings mean passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column``, ``null_count`` for all columns, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns
    ])
    return counts.select(F.inline(pairs))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def empty_alert(df: DataFrame, message: str) -> DataFrame:
    """One row with ``message`` if the table is empty, none otherwise."""
    return row_count(df).where(F.col("row_count") == 0).select(F.lit(message).alias("message"))


def distinct_count_mismatch(df: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Columns whose number of distinct values is not the expected one."""
    counts = df.agg(*[F.count_distinct(c).alias(c) for c in expected])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("found"),
                 F.lit(n).cast("bigint").alias("expected"))
        for c, n in expected.items()
    ])
    return counts.select(F.inline(rows)).where(F.col("found") != F.col("expected"))


def inconsistent_attributes(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Keys that carry more than one combination of attribute values.

    Distinct combinations first: a key with many rows is reduced before its values are counted.
    """
    versions = df.select(key, *attributes).distinct()
    return versions.groupBy(key).agg(F.count(F.lit(1)).alias("versions")).where(
        F.col("versions") > 1
    )
