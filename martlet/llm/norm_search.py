"""Exact top-k inner products by buckets of similar length.

Vectors are ranged by length and cut into buckets. A first pass over the bucket of the longest ones
gives each query a lower bound for its k-th product. A bucket whose longest vector cannot reach the
bound is skipped for a block of queries before any vector moves. Inside a bucket, a query's bound
becomes a local cosine threshold: above 1 it skips the bucket; a low one leaves length pruning (a prefix
of the bucket, which is in order of length); a high one selects by intervals of the query's largest
coordinates that such a cosine allows. What remains is verified by its whole product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import stored
from martlet.llm.vectors import (
    FOUND, best, finite, found_batch, numbered_vectors, packed, query_blocks, ranked, same_width, unpack,
)

BUCKET = 2048
BLOCK = 512
COORDINATES = 3
HIGH = 0.55  # local cosine from which coordinates prune more than lengths
_EXACT, _EXACT_LONG, _LONG = float(1 << 53), float(1 << 62), (1 << 63) - 1


def select(unit: np.ndarray, lengths: np.ndarray, query: np.ndarray, bound: float) -> np.ndarray:
    """Places of a bucket's vectors (unit rows, lengths descending) whose product may reach ``bound``."""
    size = float(np.sqrt(query @ query))
    if bound <= 0 or size == 0:
        return np.arange(len(lengths)) if bound <= 0 else np.zeros(0, np.int64)
    least = bound / size * (1 - 1e-9)
    prefix = int(np.searchsorted(-lengths, -least, "right"))
    if not prefix:
        return np.zeros(0, np.int64)
    cosine = min(1.0, least / lengths[0])
    if cosine < HIGH:
        return np.arange(prefix)
    direction = query / size
    keep = np.ones(prefix, bool)
    for c in np.argsort(-np.abs(direction))[:COORDINATES]:
        middle = direction[c] * cosine
        reach = np.sqrt((1 - cosine * cosine) * (1 - min(1.0, direction[c] ** 2))) + 1e-9
        # Interval of a unit vector's coordinate at a cosine of ``cosine`` or more; open on the side
        # where a larger cosine lies.
        low, high = middle - reach, middle + reach
        if direction[c] >= cosine:
            high = 1.0
        if -direction[c] >= cosine:
            low = -1.0
        keep &= (unit[:prefix, c] >= low) & (unit[:prefix, c] <= high)
    return np.flatnonzero(keep)


def exact(data: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same whole numbers in the fastest type that holds all their products exactly."""
    if not data.size or not queries.size:
        return data, queries
    most = float(np.abs(data).max()) * float(np.abs(queries).max()) * data.shape[1]
    if most < _EXACT:
        return data, queries
    if most < _EXACT_LONG:
        return data.astype(np.int64), queries.astype(np.int64)
    return tuple(np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (data, queries))


def _products(bucket: dict, block: dict, bounds: np.ndarray, k: int) -> list[tuple]:
    """Per query of the block its first ``k`` of the bucket, as (row, id, rows, ids, products)."""
    rows, ids, data = unpack(bucket)
    query_rows, query_ids, queries = unpack(block)
    data, queries = same_width(data, queries)
    whole, whole_queries = exact(data, queries)
    lengths = np.sqrt((data * data).sum(1))
    order = np.argsort(-lengths, kind="stable")
    rows, ids, data, whole, lengths = rows[order], ids[order], data[order], whole[order], lengths[order]
    unit = data / np.maximum(lengths, 1e-300)[:, None]
    parts = []
    for row, query_id, query, numbers, bound in zip(query_rows.tolist(), query_ids.tolist(), queries, whole_queries, bounds):
        near = select(unit, lengths, query, bound)
        near = near[rows[near] != row]
        products = whole[near] @ numbers
        if products.dtype == object:  # beyond a long stands the largest one, or the smallest
            products = np.array([min(max(int(x), -_LONG), _LONG) for x in products], np.int64)
        top = best(-products, ids[near], k)
        top = top[products[top] >= bound]
        parts.append((row, query_id, rows[near[top]], ids[near[top]], products[top]))
    return parts


def _first_bounds(k: int):
    """For a block and one bucket: each query's k-th product there, and the least of the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                none = np.full(pair["block"]["size"], -np.inf)
                parts = _products(pair["bucket"], pair["block"], none, k)
                bounds = np.array([float(p[4][k - 1]) if len(p[4]) == k else -np.inf for p in parts])
                bounds -= np.abs(bounds) * 1e-12  # a product beyond 53 bits may have been rounded up
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pair["part"]], pa.int64()), pa.array([bounds.tobytes()], pa.binary()),
                     pa.array([float(bounds.min())])], ["part", "bounds", "least"])
    return run


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = batch.slice(i, 1).to_pylist()[0]
                bounds = np.frombuffer(pair["bounds"])
                yield found_batch(_products(pair["bucket"], pair["block"], bounds, k), pa.int64())
    return run


def top_products(
    table: DataFrame, k: int = 10, every: int = 100, scale: float = 1024.0, bucket: int = BUCKET,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` largest inner products, whole numbers.

    Components become floor(scale * x). Queries are rows whose vec_id is divisible by ``every``; candidates
    all rows but the query's own, repeated ones included. Ties go to the smaller vec_id; a null vec_id is a
    candidate behind all others of its score. Vectors that are null or hold null or non-finite components
    take no part; of two vectors the shorter is filled up with zeros. Components and products beyond a long count
    as the largest or smallest one. Other columns are not read; no queries or no candidates give an empty result.
    """
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))
    vectors = numbered_vectors(table, scaled, finite("embedding"), every)
    length = F.aggregate("data", F.lit(0.0), lambda s, x: s + x * x)
    ranged = (
        vectors.withColumn("length", -length).repartitionByRange("length", "row")
        .sortWithinPartitions("length", "row").withColumn("part", F.spark_partition_id().cast("long")))
    columns = F.struct("size", "width", "rows", "ids", "data")
    buckets = stored(packed(ranged, bucket).select(
        F.monotonically_increasing_id().alias("bucket_id"), columns.alias("bucket"), "longest"))
    blocks, count = query_blocks(vectors.where("query"), BLOCK)
    blocks = stored(blocks.select("part", columns.alias("block"), F.col("longest").alias("block_longest")))
    # First pass: the bucket of the longest vectors bounds every query from below.
    first = buckets.orderBy(F.desc("longest"), "bucket_id").limit(1).withColumn("part", _each(count))
    bounds = stored(
        blocks.join(first.select("part", "bucket"), "part").select("part", "block", "bucket")
        .mapInArrow(_first_bounds(k), "part long, bounds binary, least double"))
    # Each bucket meets a block once, unless its longest vector cannot reach the least bound there.
    needs = blocks.select("part", "block_longest").join(bounds.select("part", "least"), "part")
    pairs = (
        buckets.select("bucket_id", "longest", _each(count).alias("part")).join(needs, "part")
        .where("longest * block_longest * (1 + 1e-9) >= least").select("bucket_id", "part"))
    work = (
        pairs.join(blocks.select("part", "block"), "part").join(bounds.select("part", "bounds"), "part")
        .join(buckets.select("bucket_id", "bucket"), "bucket_id"))
    return ranked(work.select("bucket", "block", "bounds").mapInArrow(_search(k), FOUND.format("long")), k, F.desc)


def _each(blocks: int):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))


ORACLE = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, cast(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""
