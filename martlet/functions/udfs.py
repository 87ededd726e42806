"""User-defined functions: the built-in form where there is one, and the Python forms."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def format_amount_jpy(amount: Column) -> Column:
    """Yen with thousands separators, cut off toward zero: ¥12,345. Runs without Python."""
    return F.concat(F.lit("¥"), F.format_number(amount.cast("bigint"), 0))


@F.udf(returnType=T.StringType(), useArrow=True)
def format_amount_jpy_udf(amount: float) -> str:
    """The same as a scalar Python function; values travel in Arrow batches."""
    return None if amount is None else f"¥{int(amount):,}"


@F.pandas_udf(T.DoubleType())
def with_tax(amount: pd.Series) -> pd.Series:
    """Ten per cent added, rounded down to whole units, a whole batch at a time."""
    return (amount * 110 // 100).astype("float64")


def register(spark: SparkSession) -> None:
    """Make the Python functions callable from SQL."""
    spark.udf.register("format_amount_jpy", format_amount_jpy_udf)
    spark.udf.register("with_tax", with_tax)
