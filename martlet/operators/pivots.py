"""Exact nearest vectors by cosine, with bounds from distances to a few pivots.

Vectors are stored with their length as 1, so that the distance d of two of them gives their cosine, 1 - d * d / 2.
Each is kept with its distances to all pivots, ordered by its nearest pivot and the distance to that one. By the
triangle inequality a vector within r of the query lies, for every pivot, within r of the query's own distance to it:
these ranges are plain filters, which reach the statistics of files and row groups.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.search import DIGITS, cosine
from martlet.sizing import limit, segment_count

SAMPLE = 1_000  # vectors of the hash sample that pivots are chosen from; it decides none of the results
_ROOM = 1e-6


def _distance(a: Sequence[float], b: Sequence[float]) -> float:
    return math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))


def _unit(v: Sequence[float]) -> list[float]:
    size = math.sqrt(sum(x * x for x in v))
    return [x / size for x in v]


def _distance_to(unit: Column, pivot: Sequence[float]) -> Column:
    fixed = F.array(*[F.lit(x) for x in pivot])
    return F.sqrt(F.aggregate(F.zip_with(unit, fixed, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))


class PivotIndex:
    """A stored index under ``path`` of vectors of one width."""

    def __init__(self, spark: SparkSession, path: str, key: str, vector: str, attributes: Sequence[str] = ()):
        self.spark, self.path, self.key, self.vector, self.attributes = spark, path.rstrip("/"), key, vector, tuple(attributes)

    def build(self, vectors: DataFrame, pivots: int = 8, rows_per_file: int | None = None, group_bytes: int = 4 << 20) -> None:
        """Vectors that are NULL, all zero or hold a NULL have no direction and are left out."""
        directed = F.exists(self.vector, lambda x: x != 0) & ~F.exists(self.vector, lambda x: x.isNull())
        rows = vectors.where(directed).select(self.key, *self.attributes, F.col(self.vector).cast("array<double>").alias(self.vector))
        count = rows.count()
        one_in = max(1, count // SAMPLE)
        sample = rows.where(F.pmod(F.xxhash64(self.key), F.lit(one_in)) == 0).orderBy(F.xxhash64(self.key), self.key).limit(2 * SAMPLE)
        units = [_unit(r[0]) for r in sample.select(self.vector).collect()]
        chosen = units[:1]
        away = [_distance(u, chosen[0]) for u in units] if chosen else []
        while chosen and len(chosen) < min(pivots, len(units)):  # the one farthest from all so far
            chosen.append(units[max(range(len(units)), key=away.__getitem__)])
            away = [min(a, _distance(u, chosen[-1])) for a, u in zip(away, units)]
        size = F.sqrt(F.aggregate(self.vector, F.lit(0.0), lambda s, x: s + x * x))
        unit = F.transform(self.vector, lambda x: x / F.col("_size"))
        placed = rows.withColumn("_size", size).withColumn("_unit", unit).withColumns(
            {f"_d{i}": _distance_to(F.col("_unit"), p) for i, p in enumerate(chosen)}).drop("_size", "_unit")
        nearest = F.array_min(F.array(*[F.struct(F.col(f"_d{i}").alias("d"), F.lit(i).alias("p")) for i in range(len(chosen))])) if chosen else None
        if chosen:
            placed = placed.withColumns({"_pivot": nearest["p"], "_near": nearest["d"]})
        else:
            placed = placed.withColumns({"_pivot": F.lit(0), "_near": F.lit(0.0)})
        files = segment_count(count, rows_per_file or limit(self.spark, "fileRows"))
        order = ["_pivot", "_near", self.key]
        placed.repartitionByRange(files, *order).sortWithinPartitions(*order).write.mode("overwrite").option(
            "parquet.block.size", group_bytes).parquet(f"{self.path}/vectors")
        self.spark.createDataFrame(list(enumerate(chosen)), "pivot int, unit array<double>").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.path}/pivots")

    def near(self, query: Sequence[float], radius: float) -> DataFrame:
        """Stored vectors that may lie within ``radius`` of the query's direction; no other does."""
        rows = self.spark.read.parquet(f"{self.path}/vectors")
        away = self._away(query)
        if radius >= 2 or not away:
            return rows
        within = lambda c, d: (F.col(c) >= d - radius - _ROOM) & (F.col(c) <= d + radius + _ROOM)
        keep = F.lit(False)
        for i, d in enumerate(away):
            keep = keep | ((F.col("_pivot") == i) & within("_near", d))
        for i, d in enumerate(away):
            keep = keep & within(f"_d{i}", d)
        return rows.where(keep)

    def _away(self, query: Sequence[float]) -> list[float]:
        unit = _unit(query)
        pivots = self.spark.read.parquet(f"{self.path}/pivots").orderBy("pivot").collect()  # a few rows
        return [_distance(unit, p["unit"]) for p in pivots]

    def top(self, query: Sequence[float], k: int, equal: dict | None = None) -> DataFrame:
        """(key, score) of the ``k`` vectors with the largest cosine, ties by key. The query has a direction."""
        def scored(rows: DataFrame) -> DataFrame:
            for column, value in (equal or {}).items():
                rows = rows.where(F.col(column) == F.lit(value))
            return rows.select(self.key, cosine(F.col(self.vector), query).alias("score"), "_near", "_pivot")

        away, radius = self._away(query), 2.0
        if away:
            pivot = min(range(len(away)), key=away.__getitem__)
            start = scored(self.spark.read.parquet(f"{self.path}/vectors").where(F.col("_pivot") == pivot))
            close = start.orderBy(F.abs(F.col("_near") - away[pivot])).limit(16 * k).orderBy(F.desc("score")).limit(k).collect()
            if len(close) == k:  # the k-th of these is at least as far as the k-th of all
                radius = math.sqrt(max(0.0, 2 - 2 * (close[-1]["score"] - 2 * 10.0**-DIGITS)))
        return scored(self.near(query, radius)).select(self.key, "score").orderBy(F.desc("score"), self.key).limit(k)
