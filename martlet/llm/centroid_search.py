"""Centroid clustering by equal-average equal-variance search, in whole numbers.

A vector's distance to a centroid is bounded from below by its distance in the mean and in the deviation from the
mean: ``d2(x, c) >= (S(x) - S(c))**2 / w + (V(x) - V(c))**2`` with ``S`` the sum and ``V`` the length of the deviation
of ``w`` components. Centroids are sorted by their means; each vector starts at its own mean and scans outward. Once
the mean alone shows that the nearer side is too far, the scan ends; a centroid whose mean and deviation show
it to be too far is passed over; for all others the distance is computed, exactly. The first test is made in
whole numbers, the second one with room for rounding, so the result is the one of a full search.

Sums and deviations of the vectors are stored once. A round is one pass over the stored vectors that moves only each
task's sums by centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.common import drop, spread, stored, with_columns_mapped
from martlet.llm.vectors import finite

_SMALL = 1 << 30  # width times the largest component, up to which squares of sums are exact in 64 bits
_LONG = (1 << 63) - 1
_ROOM = 1e-9  # what rounding may add to a bound, as a share


def moments(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of each row's components and the length of its deviation from their mean."""
    width = max(data.shape[1], 1)
    total = data.sum(1)
    square = (data * data).sum(1)
    return total, np.sqrt((width * square - total * total).astype(np.float64) / width)


def _exact(data: np.ndarray) -> np.ndarray:
    """The same numbers in a type in which sums and squares are exact."""
    small = not data.size or data.shape[1] * max(abs(int(data.min())), abs(int(data.max()))) < _SMALL
    return data.astype(np.int64 if small else object)


class Search:
    """Nearest of a few centroids; of equally near ones the one with the smaller number."""

    def __init__(self, centroids: np.ndarray):
        totals, deviations = moments(_exact(centroids))
        self.order = np.argsort(totals, kind="stable")
        self.centroids, self.totals, self.deviations = centroids[self.order], totals[self.order], deviations[self.order]
        self.computed = 0  # distances computed so far

    def nearest(self, data: np.ndarray, total: np.ndarray, deviation: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the nearest centroid of each row of ``data``."""
        both = _exact(np.concatenate((data, self.centroids)))
        data, centroids = both[:len(data)], both[len(data):]
        total, totals = total.astype(both.dtype), self.totals.astype(both.dtype)
        n, k, width = len(data), len(centroids), max(data.shape[1], 1)
        best = np.full(n, -1, both.dtype)
        number = np.full(n, -1, np.int64)
        right = np.searchsorted(totals, total)
        left = right - 1
        active = np.arange(n)
        while len(active):
            down, up = left[active], right[active]
            low = np.where(down >= 0, total[active] - totals[np.maximum(down, 0)], -1)
            high = np.where(up < k, totals[np.minimum(up, k - 1)] - total[active], -1)
            go_down = (low >= 0) & ((high < 0) | (low <= high))
            gap, at = np.where(go_down, low, high), np.where(go_down, down, up)
            left[active] -= go_down
            right[active] += ~go_down
            first = number[active] < 0
            # The nearer side's mean is too far: so are all that are left.
            alive = (gap >= 0) & (first | (gap * gap <= width * best[active]))
            active, at, gap, first = active[alive], at[alive], gap[alive], first[alive]
            aside = deviation[active] - self.deviations[at]
            bound = gap.astype(np.float64) ** 2 / width + aside * aside
            room = _ROOM * (bound + deviation[active] ** 2 + self.deviations[at] ** 2) + 1
            near = first | (bound - room <= best[active].astype(np.float64))
            rows, at = active[near], at[near]
            apart = data[rows] - centroids[at]
            distance = (apart * apart).sum(1)
            self.computed += len(rows)
            own = self.order[at]
            better = (number[rows] < 0) | (distance < best[rows]) | ((distance == best[rows]) & (own < number[rows]))
            rows = rows[better]
            best[rows], number[rows] = distance[better], own[better]
        return number, best


def _matrix(batch: pa.RecordBatch, at: int, width: int) -> np.ndarray:
    column = batch.column(at)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _add_moments(width: int, names: list[str], at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, deviation = moments(_exact(_matrix(batch, at, width)))
            totals = pa.array([int(x) for x in total], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([*batch.columns, totals, pa.array(deviation, pa.float64())], names)
    return run


def _totals(batch: pa.RecordBatch, name) -> np.ndarray:
    return np.array([int(x) for x in batch.column(name).to_pylist()] or [0], object)[:batch.num_rows]


def _sums(width: int, centroids: np.ndarray):
    """A task's rows (cluster, place, n, total): sums of the components of the vectors nearest to each centroid."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, k = Search(centroids), len(centroids)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, width), object)
        for batch in batches:
            data = _matrix(batch, batch.schema.get_field_index("data"), width)
            number, _ = search.nearest(data, _totals(batch, "total"), batch.column("deviation").to_numpy())
            counts += np.bincount(number, minlength=k)
            exact = _exact(data)
            for c in np.unique(number):
                sums[c] += exact[number == c].sum(0).astype(object)
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(own, width), pa.int32()), pa.array(np.tile(np.arange(width), len(own)), pa.int32()),
             pa.array(np.repeat(counts[own], width), pa.int64()),
             pa.array([int(x) for c in own for x in sums[c]], pa.decimal128(38, 0))],
            ["cluster", "place", "n", "total"])
    return run


def _assign(width: int, centroids: np.ndarray, names: list[str], at):
    data_at, total_at, deviation_at = map(at, ("data", "total", "deviation"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for batch in batches:
            number, best = search.nearest(
                _matrix(batch, data_at, width), _totals(batch, total_at), batch.column(deviation_at).to_numpy())
            fits = [int(d) if d <= _LONG else None for d in best]
            exact = pa.array([int(d) for d in best], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(number, pa.int32()), pa.array(fits, pa.int64()), exact], names)
    return run


def _long(exact: Column) -> Column:
    return F.when(exact <= F.lit(_LONG), exact).cast("long")


def cluster(
    table: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, seed: int = 3, scale: float = 1024.0,
) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly ``width`` components, none null or non-finite; a component becomes
    floor(scale * x), in the range of a long. Centroids start as the ``k`` vectors with the smallest sha256 of
    ``seed:vec_id``; null ids come last, and of repeated ids the vector that is first by its components. ``rounds`` times
    each vector goes to its nearest centroid (ties: the smaller number) and centroids become the floor of the mean of
    theirs; one without vectors stays. With fewer than ``k`` vectors there are as many centroids; equal rows count
    each; an empty table gives an empty result. A distance or a sum of them beyond a long is null. Other columns are not
    read. ``k`` centroids are sent to every task, and ``k * width`` sums of each task are shuffled.
    """
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    kept = spread(
        table.where((F.size("embedding") == width) & finite("embedding"))
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("data")))
    added = [T.StructField("total", T.DecimalType(38, 0)), T.StructField("deviation", T.DoubleType())]
    vectors = stored(with_columns_mapped(kept, lambda names, at: _add_moments(width, names, at("data")), added))
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = (
        vectors.select(F.col("vec_id").isNull().alias("unnamed"), named.alias("hash"), "data")
        .orderBy("unnamed", "hash", "data").limit(k).collect())
    centroids = np.array([r["data"] for r in first], np.int64).reshape(len(first), width)
    for _ in range(rounds if len(first) else 0):
        sums = (
            vectors.mapInArrow(_sums(width, centroids), "cluster int, place int, n long, total decimal(38,0)")
            .groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
        for r in sums.collect():  # k * width rows at most
            centroids[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    added = [
        T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()),
        T.StructField("_exact", T.DecimalType(38, 0))]
    assigned = stored(
        with_columns_mapped(vectors, lambda names, at: _assign(width, centroids, names, at), added)
        .select("vec_id", "cluster", "distance", "_exact"))
    drop(vectors)
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    inertia = assigned.agg(F.sum("_exact")).first()[0]
    per_cluster = (  # k rows at most
        assigned.groupBy("cluster").agg(_long(F.sum("_exact")).alias("cluster_inertia"))
        .withColumn("inertia", F.lit(int(inertia) if inertia is not None and inertia <= _LONG else None).cast("long"))
        .withColumn("centroid_sha256", F.element_at(F.lit(digests or [""]).cast("array<string>"), F.col("cluster") + 1)))
    return assigned.drop("_exact").join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 8, rounds: int = 10, width: int = 64, seed: int = 3) -> str:
    """The same in SQL, each round by all distances; for small tables with distinct ids."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, unnest(range({width})) AS place FROM kept),
first_ones AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM kept),
centroids_0 AS MATERIALIZED (SELECT c, place, x FROM first_ones JOIN parts USING (vec_id) WHERE c < {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""
nearest_{i} AS MATERIALIZED (
  SELECT vec_id, min(d * {k} + c) % {k} AS c, min(d) AS d FROM (
    SELECT p.vec_id, m.c, CAST(sum((p.x - m.x) * (p.x - m.x)) AS BIGINT) AS d
    FROM parts p JOIN centroids_{i} m ON m.place = p.place GROUP BY p.vec_id, m.c) AS distances
  GROUP BY vec_id)""")
        if i < rounds:
            steps.append(f"""
sums_{i} AS (SELECT c, place, sum(x) AS s, count(*) AS n FROM nearest_{i} JOIN parts USING (vec_id) GROUP BY c, place),
centroids_{i + 1} AS MATERIALIZED (
  SELECT m.c, m.place, CASE WHEN s.n IS NULL THEN m.x ELSE CAST((s.s - ((s.s % s.n) + s.n) % s.n) // s.n AS BIGINT) END AS x
  FROM centroids_{i} m LEFT JOIN sums_{i} s ON s.c = m.c AND s.place = m.place)""")
    return "WITH " + ",".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM nearest_{rounds} JOIN (
  SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256 FROM centroids_{rounds} GROUP BY c)
USING (c)"""
