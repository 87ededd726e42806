"""A metric model: tables, keys, relationships, dimensions and metrics, compiled to a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.quality import duplicate_keys
from martlet.sizing import lookup_join


@dataclass(frozen=True)
class Relationship:
    """``fact.column`` refers to the declared key of ``table``."""

    column: str
    table: str


@dataclass(frozen=True)
class Dimension:
    """A column to group by: of the fact (table None) or of a related table."""

    column: str
    table: str | None = None


@dataclass
class MetricModel:
    """``keys`` declare which column of a related table is unique; ``facts`` are row-level columns
    computed before aggregation; ``metrics`` are aggregates over fact columns and facts."""

    fact: DataFrame
    tables: dict[str, DataFrame]
    keys: dict[str, str]
    relationships: list[Relationship]
    dimensions: dict[str, Dimension]
    metrics: dict[str, Column]
    facts: dict[str, Column] = field(default_factory=dict)

    def check_keys(self, tables: Sequence[str] | None = None) -> None:
        """Fail if a declared key is not unique: joining such a table would multiply the facts."""
        for name in self.keys if tables is None else tables:
            if not duplicate_keys(self.tables[name], [self.keys[name]]).isEmpty():
                raise ValueError(f"key {self.keys[name]} of {name} is not unique")

    def query(
        self,
        metrics: Sequence[str],
        by: Sequence[str] = (),
        equal: dict[str, object] | None = None,
    ) -> DataFrame:
        """Metrics grouped by dimensions, over rows whose dimensions ``equal`` the given values.

        Only tables that one of these dimensions needs are joined.
        """
        equal = equal or {}
        used = list(dict.fromkeys([*by, *equal]))
        unknown = [m for m in metrics if m not in self.metrics] + [
            d for d in used if d not in self.dimensions
        ]
        if unknown:
            raise KeyError(f"not in the model: {unknown}")
        needed = {self.dimensions[name].table for name in used} - {None}
        self.check_keys(sorted(needed))
        rows = self.fact.withColumns(self.facts) if self.facts else self.fact
        for name in used:
            if self.dimensions[name].table is None:
                rows = rows.withColumn(f"_{name}", F.col(self.dimensions[name].column))
        for relationship in self.relationships:
            if relationship.table in needed:
                side = self.tables[relationship.table].select(
                    F.col(self.keys[relationship.table]).alias(relationship.column),
                    *[
                        F.col(self.dimensions[name].column).alias(f"_{name}")
                        for name in used
                        if self.dimensions[name].table == relationship.table
                    ],
                )
                rows = lookup_join(rows, side, relationship.column)
        for name, value in equal.items():
            rows = rows.where(F.col(f"_{name}") == F.lit(value))
        return rows.groupBy(*[F.col(f"_{name}").alias(name) for name in by]).agg(
            *[self.metrics[m].alias(m) for m in metrics]
        )
