"""Approximate nearest neighbours by learned partitions of a neighbour graph.

1. A sample of at most ``sample`` vectors, those with the smallest hash of their row, gives a graph of
   nearest neighbours. It is cut into ``parts`` balanced parts by repeated halving: spectral order,
   split at the median, then exchanges of pairs that save edges.
2. A small classifier, one softmax layer over the vector and its closeness to the parts' means, learns in which
   parts a vector's neighbours lie. Its size depends on the parameters alone.
3. A quarter of the sample, which the classifier has not seen, says how much probability a query's parts must hold
   together so that they hold the wanted share of its neighbours.
4. Every row of the table goes to its most probable part. A query is sent to its most probable parts until they
   hold that much: few where vectors have clusters, many where they have none. Everything in them is ranked by its
   distance to the query on the original vectors.

Parts are split over many packed matrices of bounded size, so a part may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import stored
from martlet.llm.vectors import (
    FOUND, best, finite, found_batch, matrix, numbered_vectors, packed, ranked, same_width, unpack,
)

SAMPLE = 4096
PARTS, MOST_PARTS = 32, 128  # as many as the sample can teach
PART_ROWS = 1 << 16  # rows of a part from which on there are more parts
RECALL = 0.94  # share of the held-out sample's neighbours that the searched parts hold
NEIGHBOURS = 10
CHUNK = 2048
BLOCK = 256


def neighbour_graph(data: np.ndarray, degree: int) -> np.ndarray:
    """Symmetric 0/1 matrix that joins each row to its ``degree`` nearest."""
    norms = (data * data).sum(1)
    distance = norms[:, None] + norms[None, :] - 2 * data @ data.T
    np.fill_diagonal(distance, np.inf)
    degree = min(degree, len(data) - 1)
    graph = np.zeros(distance.shape, np.float32)
    if degree > 0:
        near = np.argpartition(distance, degree - 1, axis=1)[:, :degree]
        np.put_along_axis(graph, near, 1.0, axis=1)
    return np.maximum(graph, graph.T)


def halve(graph: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Balanced half of a graph with few edges to the other: True for one half."""
    n = len(graph)
    degree = graph.sum(1) + 1e-9
    trivial = np.sqrt(degree) / np.sqrt(degree.sum())
    scaled = graph / np.sqrt(degree)[:, None] / np.sqrt(degree)[None, :]
    order = rng.standard_normal(n)
    for _ in range(60):
        order = order + scaled @ order
        order -= trivial * (trivial @ order)
        order /= np.linalg.norm(order) + 1e-12
    side = np.zeros(n, bool)
    side[np.argsort(order / np.sqrt(degree), kind="stable")[n // 2:]] = True
    for _ in range(20):  # exchange as many vertices of both sides as save edges
        inside = np.where(side, graph @ side, graph @ ~side)
        gain = degree - 2 * inside
        a, b = (np.flatnonzero(s)[np.argsort(-gain[s], kind="stable")][:max(1, n // 50)] for s in (side, ~side))
        pairs = [(i, j) for i, j in zip(a, b) if gain[i] + gain[j] - 2 * graph[i, j] > 0]
        if not pairs:
            break
        before = graph[side][:, ~side].sum()
        changed = side.copy()
        changed[[i for i, _ in pairs]] = False
        changed[[j for _, j in pairs]] = True
        if graph[changed][:, ~changed].sum() >= before:
            break
        side = changed
    return side


def partition(graph: np.ndarray, parts: int, seed: int = 0) -> np.ndarray:
    """Part of each vertex; parts is a power of two, and sizes differ by rounding only."""
    rng, labels = np.random.default_rng(seed), np.zeros(len(graph), np.int64)
    size = 1
    while size < parts:
        for part in range(size):
            members = np.flatnonzero(labels == part)
            if len(members) > 1:
                side = halve(graph[np.ix_(members, members)], rng)
                labels[members[side]] += size
        size *= 2
    return labels


class Router:
    """Softmax classifier from a vector to probabilities of parts."""

    def __init__(self, parts: int, width: int):
        self.parts, self.width = parts, width
        self.shift, self.scale = np.zeros(width), 1.0
        self.means = np.zeros((parts, width))
        self.weights = np.zeros((width + parts + 1, parts))
        self.mass = 1.0

    def features(self, data: np.ndarray) -> np.ndarray:
        if data.shape[1] < self.width:
            data = np.pad(data, ((0, 0), (0, self.width - data.shape[1])))
        x = (data[:, :self.width] - self.shift) / self.scale
        near = -((x * x).sum(1)[:, None] + (self.means * self.means).sum(1)[None] - 2 * x @ self.means.T)
        near = near / max(1, self.width)
        return np.concatenate((x / np.sqrt(max(1, self.width)), near, np.ones((len(x), 1))), 1)

    def fit(self, data: np.ndarray, labels: np.ndarray, wanted: np.ndarray, steps: int = 400, rate: float = 0.1) -> Router:
        """Learn ``wanted``, the shares of each row's neighbours by part; ``labels`` are the rows' own parts."""
        self.shift = data.mean(0)
        self.scale = float(data.std()) or 1.0
        x = (data - self.shift) / self.scale
        self.means = np.stack([x[labels == p].mean(0) if (labels == p).any() else x.mean(0) for p in range(self.parts)])
        f = self.features(data)
        first, second = np.zeros_like(self.weights), np.zeros_like(self.weights)
        for step in range(1, steps + 1):  # Adam on the whole sample
            gradient = f.T @ (self.probabilities(f) - wanted) / len(f) + 1e-5 * self.weights
            first = 0.9 * first + 0.1 * gradient
            second = 0.99 * second + 0.01 * gradient**2
            self.weights -= rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        return self

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        z = features @ self.weights
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def ordered(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All parts of each row, the most probable first, and the probability of those before each.

        Rounded, so that the sums of a batch of another size do not change the order.
        """
        p = np.round(self.probabilities(self.features(data)), 9)
        order = np.argsort(-p, 1, kind="stable")
        held = np.take_along_axis(p, order, 1)
        return order, np.cumsum(held, 1) - held

    def route(self, data: np.ndarray, probes: int | None = None) -> list[np.ndarray]:
        """The parts each row's neighbours are looked for in: ``probes`` of them, or until they hold ``mass``."""
        order, before = self.ordered(data)
        count = np.full(len(data), probes) if probes else np.maximum(1, (before < self.mass).sum(1))
        return [o[:n] for o, n in zip(order, count)]


def train(data: np.ndarray, parts: int, degree: int = NEIGHBOURS, seed: int = 0, recall: float = RECALL) -> Router:
    router = Router(parts, data.shape[1])
    if not len(data):
        return router
    graph = neighbour_graph(data, degree)
    labels = partition(graph, parts, seed)
    wanted = graph @ np.eye(parts)[labels] + np.eye(parts)[labels]
    wanted /= wanted.sum(1, keepdims=True)
    taught = np.arange(len(data)) % 4 != 3 if len(data) >= 64 else np.ones(len(data), bool)
    router.fit(data[taught], labels[taught], wanted[taught])
    if not taught.all():  # how far down a query's parts do the neighbours of those not seen lie
        order, before = router.ordered(data)
        place = np.argsort(order, 1)
        own, near = np.nonzero(graph * ~taught[:, None])
        router.mass = float(np.quantile(before[own, place[own, order[near, 0]]], recall)) + 1e-6
    return router


def _routed(model, probes: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = model.value.route(matrix(batch), probes)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array([p.tolist() for p in parts], pa.list_(pa.int64()))], ["row", "parts"])
    return run


def _assigned(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            part = model.value.ordered(matrix(batch))[0][:, 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), batch["row"], batch["id"], batch["data"]], ["part", "row", "id", "data"])
    return run


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = batch.slice(i, 1).to_pylist()[0]
                rows, ids, data = unpack(pair["chunk"])
                query_rows, query_ids, queries = unpack(pair["block"])
                data, queries = same_width(data, queries)
                parts = []
                for row, query_id, query in zip(query_rows.tolist(), query_ids.tolist(), queries):
                    away = data - query
                    distance = np.sqrt(np.einsum("ij,ij->i", away, away))
                    distance[rows == row] = np.inf
                    top = best(distance, ids, k)
                    top = top[distance[top] < np.inf]
                    parts.append((row, query_id, rows[top], ids[top], distance[top]))
                yield found_batch(parts, pa.float64())
    return run


def parts_for(rows: int) -> int:
    """Parts of a table: a power of two that grows with its rows."""
    parts = PARTS
    while parts < MOST_PARTS and rows > parts * PART_ROWS:
        parts *= 2
    return parts


def nearest(
    table: DataFrame, k: int = 10, every: int = 100, parts: int | None = None, probes: int | None = None,
    sample: int = SAMPLE, seed: int = 0, recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each query, by Euclidean distance.

    Queries are rows whose vec_id is divisible by ``every``; candidates all rows but the query's own,
    repeated ones included. Ties go to the smaller vec_id; a null vec_id comes behind all others of its
    distance. Vectors that are null, zero, or hold null or non-finite components take no part; of two
    vectors the shorter is filled up with zeros. ``sample`` bounds what the partition and the classifier
    are fitted on; every row is indexed. Of ``parts`` parts (by default more for larger tables) those are searched that
    hold the ``recall`` share of neighbours in a held-out part of the sample, or ``probes`` for every query: with all
    of them the result is exact. Other columns are not read; no queries or candidates give an empty result.
    """
    if parts is not None and (parts < 1 or parts & (parts - 1)):
        raise ValueError("parts is a power of two")
    spark = table.sparkSession
    values = F.transform("embedding", lambda x: x.cast("double"))
    keep = finite("embedding") & F.exists("embedding", lambda x: x != 0)
    vectors = numbered_vectors(table, values, keep, every)
    parts = parts or parts_for(vectors.count())
    fitted = vectors.orderBy(F.xxhash64(F.lit(seed), "row"), "row").limit(sample).select("data").toArrow()
    data = matrix(fitted.combine_chunks().to_batches()[0]) if len(fitted) else np.zeros((0, 1))
    model = spark.sparkContext.broadcast(train(data, parts, seed=seed, recall=recall))
    columns = F.struct("size", "width", "rows", "ids", "data")
    assigned = vectors.select("row", "id", "data").mapInArrow(
        _assigned(model), "part long, row long, id long, data array<double>")
    chunks = stored(
        packed(assigned.sortWithinPartitions("part", "row"), CHUNK).select("part", columns.alias("chunk")))
    queries = vectors.where("query").select("row", "id", "data")
    routed = queries.mapInArrow(_routed(model, probes), "row long, parts array<long>")
    sent = routed.select("row", F.explode("parts").alias("part")).join(queries, "row")
    # Blocks of one part and about BLOCK queries: a part that many queries ask for has many blocks.
    share = max(1, -(-queries.count() // BLOCK))
    dealt = (
        sent.repartition("part", F.pmod(F.xxhash64("row"), F.lit(share)))
        .sortWithinPartitions("part", "row"))
    blocks = stored(packed(dealt, BLOCK).select("part", columns.alias("block")))
    work = chunks.join(blocks, "part").select("chunk", "block")
    return ranked(work.mapInArrow(_search(k), FOUND.format("double")), k, F.asc)
