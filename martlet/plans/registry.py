"""Catalogue of named queries, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.plans.workspace import Workspace


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[Workspace], DataFrame]
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of a workspace as a named query; ``sql`` is its independent statement."""

    def add(function):
        if name in CATALOGUE:
            raise ValueError(f"query {name} is registered twice")
        CATALOGUE[name] = Query(name, function, sql)
        return function

    return add


def portable(df: DataFrame) -> DataFrame:
    """Decimals as double and dates as text, so two engines print the same values."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return df.select(*columns)
