"""Aggregates of a keyed table that follow its changes.

The groups are a keyed table of their own. A refresh reads the source's change feed since the last one, sums it
with a sign for each group (rows that left count -1), looks up these groups only, and merges their new
values as one batch under the source's batch number. So a refresh that is repeated changes nothing, and other groups
are neither read nor written.

Counts and sums take a departure as a negative number. A minimum or maximum is computed again from the source,
for its group alone, only when a row that held it left and no row that came reaches it. A distinct count is
the number of groups by the counted column too, which are maintained in the same way and whose own feed says which
values came and went.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators.keyed import HASH, KeyedTable, join_keys, key_hash
from martlet.sizing import limit, stored

ROWS = "_rows"


@dataclass(frozen=True)
class Measure:
    """``kind``: count (of rows, or of values of a column), sum, min, max, distinct."""

    kind: str
    column: str | None = None


def _total_type(of: T.DataType) -> T.DataType:
    if isinstance(of, T.DecimalType):
        return T.DecimalType(38, of.scale)
    if isinstance(of, T.IntegralType):
        return T.LongType()
    raise ValueError("only whole numbers and decimals are summed: floating point cannot take a row back exactly")


class MaintainedAggregate:
    """Groups of ``source`` by columns of ``derive(rows)``, stored under ``path``."""

    def __init__(
        self, source: KeyedTable, path: str, by: Sequence[str], measures: dict[str, Measure],
        derive: Callable[[DataFrame], DataFrame] = lambda rows: rows, buckets: int = 16,
    ):
        self.spark, self.source, self.by, self.measures, self.derive = source.spark, source, list(by), measures, derive
        inner = derive(self.spark.createDataFrame([], source.rows)).schema
        fields = [*[inner[c] for c in self.by], T.StructField(ROWS, T.LongType())]
        self.distinct: dict[str, MaintainedAggregate] = {}
        for name, m in measures.items():
            if m.kind in ("sum", "min", "max"):
                of = inner[m.column].dataType
                fields.append(T.StructField(name, _total_type(of) if m.kind == "sum" else of))
            elif m.kind in ("count", "distinct"):
                fields.append(T.StructField(name, T.LongType()))
            else:
                raise ValueError(f"no measure {m.kind}")
            if m.kind == "sum":  # a sum of no values is NULL
                fields.append(T.StructField(f"_{name}_values", T.LongType()))
            if m.kind == "distinct":
                self.distinct[name] = MaintainedAggregate(
                    source, f"{path}_{name}", [*self.by, m.column], {}, derive, buckets)
        self.groups = KeyedTable(self.spark, path, T.StructType(fields), self.by, buckets)

    def on(self, spark: SparkSession) -> MaintainedAggregate:
        """The same aggregate in another session."""
        other = copy.copy(self)
        other.spark, other.source, other.groups = spark, self.source.on(spark), self.groups.on(spark)
        other.distinct = {name: inner.on(spark) for name, inner in self.distinct.items()}
        return other

    # ---- reading ------------------------------------------------------------------------------

    def read(self) -> DataFrame:
        """Group columns and measures as of the last refresh."""
        sums = {n for n, m in self.measures.items() if m.kind == "sum"}
        values = [F.when(F.col(f"_{n}_values") > 0, F.col(n)).alias(n) if n in sums else F.col(n) for n in self.measures]
        return self.groups.state().select(*self.by, *values)

    # ---- refreshing ---------------------------------------------------------------------------

    def _signed(self, after: int | None, upto: int) -> DataFrame:
        """Derived rows that came (``_sign`` 1) and left (-1)."""
        if after is None:
            return self.derive(self.source.state()).withColumn("_sign", F.lit(1))
        feed = self.source.feed(after, upto)
        came, left = (self.derive(feed.where(F.col("_action") == a).drop("_action", "_is_update")) for a in ("INSERT", "DELETE"))
        return came.withColumn("_sign", F.lit(1)).unionByName(left.withColumn("_sign", F.lit(-1)))

    def changes(self, after: int | None, upto: int) -> DataFrame:
        """What the feed adds to each group it touches: one aggregate with partial results in every task."""
        sign, out = F.col("_sign"), [F.sum("_sign").alias(ROWS)]
        for name, m in self.measures.items():
            value = F.col(m.column) if m.column else F.lit(1)
            if m.kind == "count":
                out.append(F.sum(F.when(value.isNotNull(), sign).otherwise(0)).alias(name))
            elif m.kind == "sum":
                out += [F.sum(sign * value).alias(name), F.sum(F.when(value.isNotNull(), sign).otherwise(0)).alias(f"_{name}_values")]
            elif m.kind in ("min", "max"):
                best = F.min if m.kind == "min" else F.max
                out += [best(F.when(sign > 0, value)).alias(f"_{name}_in"), best(F.when(sign < 0, value)).alias(f"_{name}_out")]
        touched = self._signed(after, upto).groupBy(*self.by).agg(*out)
        touched = touched.select(key_hash(self.by).alias(HASH), "*")
        for name, inner in self.distinct.items():
            feed = inner.groups.feed(after, upto)
            appeared = F.when(F.col("_action") == "INSERT", 1).otherwise(-1)
            counted = F.col(self.measures[name].column).isNotNull() & ~F.col("_is_update")
            own = feed.where(counted).groupBy(*self.by).agg(F.sum(appeared).alias(name)).select(
                key_hash(self.by).alias(HASH), *self.by, name)
            touched = join_keys(touched, own, self.by, "left").select(
                HASH, *self.by, *[c for c in touched.columns if c != HASH and c not in self.by], name)
        return touched

    def _updated(self, name: str, m: Measure) -> list[Column]:
        """New values of a measure, and whether it has to be computed again."""
        old, new = F.col(f"_row.{name}"), F.col(name) if m.kind not in ("min", "max") else None
        added = lambda c: (F.coalesce(F.col(f"_row.{c}"), F.lit(0)) + F.coalesce(F.col(c), F.lit(0))).cast(
            self.groups.rows[c].dataType).alias(c)
        if m.kind == "sum":
            return [added(name), added(f"_{name}_values")]
        if new is not None:
            return [added(name)]
        came, left = F.col(f"_{name}_in"), F.col(f"_{name}_out")
        best = F.least if m.kind == "min" else F.greatest
        reaches = (lambda a, b: a <= b) if m.kind == "min" else (lambda a, b: a >= b)
        lost = F.coalesce(reaches(left, old), F.lit(False)) & ~F.coalesce(reaches(came, old), F.lit(False))
        return [best(old, came).alias(name), lost.alias(f"_{name}_lost")]

    def refresh(self, commit_ts: Column) -> bool:
        """Bring the groups up to the source's last batch; False if they are there already."""
        upto, after = self.source.last_batch(), self.groups.last_batch()
        for inner in self.distinct.values():
            inner.refresh(commit_ts)
        if upto is None or upto == after:
            return False
        touched = stored(self.changes(after, upto))
        joined = self.groups.present(touched)
        rows = (F.coalesce(F.col(f"_row.{ROWS}"), F.lit(0)) + F.col(ROWS)).alias(ROWS)
        values = [c for name, m in self.measures.items() for c in self._updated(name, m)]
        updated = stored(joined.select(HASH, *self.by, rows, *values))
        extremes = {n: m for n, m in self.measures.items() if m.kind in ("min", "max")}
        alive = updated.where(F.col(ROWS) > 0)
        if extremes:
            any_lost = F.lit(False)
            for name in extremes:
                any_lost = any_lost | F.col(f"_{name}_lost")
            lost = alive.where(any_lost).select(HASH, *self.by)
            if not lost.isEmpty():
                best = {"min": F.min, "max": F.max}
                again = join_keys(
                    self.derive(self.source.state()).select(key_hash(self.by).alias(HASH), "*"), lost, self.by, "left_semi",
                    limit(self.spark, "broadcastRows"),
                ).groupBy(HASH, *self.by).agg(*[best[m.kind](m.column).alias(f"_{n}_again") for n, m in extremes.items()])
                # With the right side's keys gone, a group that was not computed again has no _right.
                alive = join_keys(alive, again, self.by, "left").withColumns({
                    n: F.when(F.col(f"_{n}_lost"), F.col(f"_{n}_again")).otherwise(F.col(n)) for n in extremes})
        columns = [c for c in self.groups.rows.names[:-1]]
        gone = updated.where(F.col(ROWS) <= 0).select(*self.by)
        return self.groups.merge(upto, alive.select(*columns), gone, commit_ts)
