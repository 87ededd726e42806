"""Reads that depend on who is asking: column masks and row policies."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stars(column: Column) -> Column:
    """Every character replaced by a star; NULL stays NULL."""
    return F.regexp_replace(column, ".", "*")


@dataclass(frozen=True)
class Mask:
    """Roles that may see a column as it is, and what everyone else sees."""

    clear_for: frozenset[str]
    hidden: Callable[[Column], Column] = stars


@dataclass(frozen=True)
class RowPolicy:
    """Rows each role may see: all of them, those meeting a condition, or (by default) none."""

    all_rows_for: frozenset[str]
    conditions: dict[str, Column] = field(default_factory=dict)


def apply_masks(df: DataFrame, role: str, masks: dict[str, Mask]) -> DataFrame:
    """The role is known when the query is planned, so clear columns cost nothing."""
    hidden = {
        name: mask.hidden(F.col(name)) for name, mask in masks.items() if role not in mask.clear_for
    }
    return df.withColumns(hidden) if hidden else df


def apply_row_policy(df: DataFrame, role: str, policy: RowPolicy) -> DataFrame:
    if role in policy.all_rows_for:
        return df
    return df.where(policy.conditions.get(role, F.lit(False)))


def governed(df: DataFrame, role: str, policy: RowPolicy, masks: dict[str, Mask]) -> DataFrame:
    """Both. The policy sees true values, so masking a column cannot change which rows are shown."""
    return apply_masks(apply_row_policy(df, role, policy), role, masks)


def rows_of_principal(df: DataFrame, column: str, principal: str) -> DataFrame:
    """Rows that belong to the person asking."""
    return df.where(F.col(column) == principal)


def publish(df: DataFrame, columns: Iterable[str], path: str) -> None:
    """Write only the columns that may be shared. Readers get a table, not a view definition."""
    df.select(*columns).write.mode("overwrite").parquet(path)
