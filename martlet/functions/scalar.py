"""Scalar helpers for functions Spark names differently or that need a safe form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iff(condition: Column, yes, no) -> Column:
    return F.when(condition, yes).otherwise(no)


def tier(amount: Column, steps: list[tuple[int, str]], below: str) -> Column:
    """Label of the first step whose threshold ``amount`` reaches, highest first."""
    (at_least, label), *rest = steps
    expression = F.when(amount >= at_least, label)
    for at_least, label in rest:
        expression = expression.when(amount >= at_least, label)
    return expression.otherwise(below)


def safe_divide(amount: Column, by: Column) -> Column:
    """Quotient, NULL when the divisor is zero."""
    return amount / F.nullif(by, F.lit(0))


def share(part: Column, whole: Column, digits: int) -> Column:
    """``part`` as a percentage of ``whole``, rounded, as double."""
    return F.round(part.cast("double") / whole.cast("double") * 100, digits)


def mean(amount: str, digits: int | None = 4) -> Column:
    """Average as a double: total and count are exact, one division at the end; rounded if asked."""
    average = F.sum(amount).cast("double") / F.count(amount)
    return average if digits is None else F.round(average, digits)


def month_start(moment: Column) -> Column:
    """First day of the month as a timestamp without zone, whatever the session's zone."""
    return F.trunc(F.to_date(moment), "month").cast("timestamp_ntz")
