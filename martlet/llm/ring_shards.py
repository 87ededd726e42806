"""Assign documents to shards on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``nodes`` points of a 64-bit ring; an arc between two points belongs to the shard at
its clockwise end. A document's key falls into one arc. When that shard is full the document goes on
clockwise to the next shard with room. Keys come in the order of arcs, those that find room on their own shard
first, so the loads follow from the number of keys in each arc alone: the walk is done on these counts,
of which there are ``shards * nodes * SLICES``, and gives for each arc the ranks that go to
each shard. One narrow sort then ranks the documents; texts are never moved.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import deque

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import numbered

NODES = 64
SLICES = 16  # an arc is ranked in so many tasks, so one key with very many rows is split
CELLS = 4096


def ring(shards: int, nodes: int, seed: int = 0) -> list[tuple[int, int]]:
    """Points of the ring, clockwise: (place as a signed 64-bit number, shard)."""
    points = {}
    for shard in range(shards):
        for node in range(nodes):
            place = xxhash.xxh64_intdigest(f"{seed}:{shard}:{node}") - (1 << 63)
            points.setdefault(place, shard)
    return sorted(points.items())


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows each shard takes at most: equal but for one, or ``1 + slack`` times the mean."""
    if slack:
        return [math.ceil((1 + slack) * rows / shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(points: list[tuple[int, int]], counts: dict[int, int], room: list[int]) -> list[tuple]:
    """(arc, first rank, end rank, shard, first slot) so that every shard holds its room at most.

    Keys of an arc take the room of its own shard first; what overflows goes on clockwise.
    """
    room, used, plan = list(room), [0] * len(room), []

    def place(arc: int, first: int, end: int, shard: int) -> int:
        n = min(end - first, room[shard])
        if n:
            plan.append((arc, first, first + n, shard, used[shard]))
            room[shard] -= n
            used[shard] += n
        return first + n

    over: list[tuple[int, int, int]] = []
    for arc, (_, shard) in enumerate(points):
        end = counts.get(arc, 0)
        first = place(arc, 0, end, shard)
        if first < end:
            over.append((arc, first, end))
    waiting: deque = deque()
    starts = {arc: (first, end) for arc, first, end in over}
    for lap in range(2):
        for arc, (_, shard) in enumerate(points):
            while waiting and room[shard]:
                source, first, end = waiting.popleft()
                first = place(source, first, end, shard)
                if first < end:
                    waiting.appendleft((source, first, end))
            if lap == 0 and arc in starts:
                waiting.append((arc, *starts[arc]))
    return plan


def assign(
    docs: DataFrame, shards: int = 40, nodes: int = NODES, slack: float = 0.0, seed: int = 0,
) -> DataFrame:
    """Per row of ``docs``: doc_id, size (UTF-8 bytes of the text and 16), text_crc32, shard, slot.

    With no slack the numbers of rows of any two shards differ by one at most; with slack a shard takes
    up to ``1 + slack`` times the mean, and adding a shard moves fewer rows. Slots run from 0 without
    gaps in each shard. The key is doc_id, also if null; repeated rows share a place on the ring and are
    rows of their own. A null text has no bytes. Other columns are not read; an empty table gives an
    empty result.
    """
    if shards < 1 or nodes < 1 or slack < 0:
        raise ValueError("shards and nodes are at least 1, slack at least 0")
    spark = docs.sparkSession
    text = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    base = numbered(
        docs, F.col("doc_id"), (F.length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    points = ring(shards, nodes, seed)
    places = [p for p, _ in points]
    width = (1 << 64) // CELLS
    cells = []
    for cell in range(CELLS):  # parts of arcs inside each cell of the ring; arc i ends at point i
        low, top = cell * width - (1 << 63), (cell + 1) * width - (1 << 63) - 1
        while low <= top:
            arc = bisect_left(places, low)
            end = min(top, places[arc]) if arc < len(places) else top
            cells.append((cell, low, end, arc % len(places)))
            low = end + 1
    arcs = spark.createDataFrame(cells, "cell int, low long, high long, arc int")  # CELLS + points rows
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    keyed = (
        base.withColumn("key", key)
        .withColumn("cell", (F.shiftright("key", 52) + CELLS // 2).cast("int"))
        .join(F.broadcast(arcs), "cell").where("key BETWEEN low AND high")
        .withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(SLICES)).cast("int"))
        .select("row", "doc_id", "size", "text_crc32", "key", "arc", "slice"))
    # At most shards * nodes * SLICES counts, whatever the input.
    sizes = sorted((r.arc, r.slice, r.n) for r in keyed.groupBy("arc", "slice").agg(F.count(F.lit(1)).alias("n")).collect())
    counts: dict[int, int] = {}
    offsets = []
    for arc, part, n in sizes:
        offsets.append((arc, part, counts.get(arc, 0)))
        counts[arc] = counts.get(arc, 0) + n
    plan = walk(points, counts, capacities(sum(counts.values()), shards, slack))
    # Where a slice's ranks cross the bounds of the plan: each step ends a slice or a run of the plan.
    runs: dict[int, list[tuple]] = {}
    for arc, first, end, shard, slot in plan:
        runs.setdefault(arc, []).append((first, end, shard, slot))
    steps = []
    for arc, part, offset in offsets:
        for first, end, shard, slot in runs.get(arc, []):
            steps.append((arc, part, first - offset, end - offset, shard, slot + offset - first))
    steps = spark.createDataFrame(steps, "arc int, slice int, first long, end long, shard int, shift long")
    rank = F.row_number().over(Window.partitionBy("arc", "slice").orderBy("key", "row")).cast("long") - 1
    return (
        keyed.withColumn("rank", rank).join(F.broadcast(steps), ["arc", "slice"])
        .where("rank >= first AND rank < end")
        .select("doc_id", "size", "text_crc32", "shard", (F.col("shift") + F.col("rank")).alias("slot")))
