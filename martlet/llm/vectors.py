"""Vectors of a column as numbered rows, packed into matrices of bounded size, and partial top lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import stored

NO_ID = np.iinfo(np.int64).max  # stands for a null id inside a matrix: behind all others
PACKED = "part long, size int, width int, rows binary, ids binary, data binary, longest double, shortest double"


def finite(vector: str) -> Column:
    """Whether an array of numbers is there and holds neither null nor a non-finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~bad


def numbered_vectors(table: DataFrame, vector: Column, keep: Column, every: int) -> DataFrame:
    """(row, id, query, data) of the vectors to ``keep``; queries have an id divisible by ``every``."""
    vectors = table.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"), vector.alias("data"))
    return stored(vectors.where(keep).withColumn("query", F.coalesce(F.col("id") % every == 0, F.lit(False))))


def matrix(batch: pa.RecordBatch, column: str = "data") -> np.ndarray:
    """Rows of an array column as float64, shorter ones filled up with zeros."""
    values = batch[column].to_pylist()
    width = max(map(len, values), default=0)
    out = np.zeros((len(values), width))
    for i, row in enumerate(values):
        out[i, :len(row)] = row
    return out


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, ids and matrix of a packed row."""
    data = np.frombuffer(row["data"]).reshape(row["size"], row["width"])
    return np.frombuffer(row["rows"], np.int64), np.frombuffer(row["ids"], np.int64), data


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (a, b))


def _pack(most: int):
    names = [x.split()[0] for x in PACKED.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch["part"].to_numpy()
            cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)]):
                for begin in range(low, high, most):
                    piece = batch.slice(begin, min(most, high - begin))
                    data = matrix(piece)
                    ids = piece["id"].fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
                    lengths = np.sqrt((data * data).sum(1))
                    row = [int(part[begin]), len(data), data.shape[1], piece["row"].to_numpy().astype(np.int64).tobytes(),
                           ids.tobytes(), data.tobytes(), float(lengths.max()), float(lengths.min())]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)
    return run


def packed(rows: DataFrame, most: int) -> DataFrame:
    """(part, row, id, data), sorted within partitions, as matrices of one part and ``most`` rows each."""
    return rows.select("part", "row", "id", "data").mapInArrow(_pack(most), PACKED)


FOUND = "query_row long, query_id long, row long, id long, score {}"


def found_batch(parts: list[tuple], score: pa.DataType) -> pa.RecordBatch:
    """Partial results: lists of (query row, query id, rows, ids, scores)."""
    sizes = [len(p[2]) for p in parts]
    joined = [np.concatenate([np.zeros(0, np.int64), *[p[i] for p in parts]]) for i in (2, 3)]
    scores = np.concatenate([np.zeros(0, score.to_pandas_dtype()), *[p[4].astype(score.to_pandas_dtype()) for p in parts]])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(np.array([p[0] for p in parts], np.int64), sizes)),
         pa.array(np.repeat(np.array([p[1] for p in parts], np.int64), sizes)),
         pa.array(joined[0]), pa.array(joined[1]), pa.array(scores, score)],
        ["query_row", "query_id", "row", "id", "score"])


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` smallest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        limit = np.partition(scores, k - 1)[k - 1]
        near = np.flatnonzero(scores <= limit)
        return near[np.lexsort((ids[near], scores[near]))[:k]]
    return np.lexsort((ids, scores))[:k]


def ranked(found: DataFrame, k: int, order: Callable[[str], Column]) -> DataFrame:
    """The first ``k`` of each query as (query_id, rank, vec_id, score).

    Spark keeps ``k`` rows of each query in each task before it shuffles them.
    """
    window = Window.partitionBy("query_row").orderBy(order("score"), F.col("id"), F.col("row"))
    return (
        found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"),
                F.when(F.col("id") != int(NO_ID), F.col("id")).alias("vec_id"), "score"))


def query_blocks(queries: DataFrame, most: int) -> tuple[DataFrame, int]:
    """Queries (row, id, data) in packed blocks of about ``most``, numbered from 0, and their number."""
    blocks = max(1, -(-queries.count() // most))
    dealt = (
        queries.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        .repartition("part").sortWithinPartitions("part", "row"))
    return packed(dealt, 8 * most), blocks
