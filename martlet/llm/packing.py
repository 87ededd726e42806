"""Pack documents into training windows by deficit round-robin over source queues.

Each source is a queue of tokens. A queue earns credit in proportion to its weight with every token
packed and is served ``quantum`` tokens when its credit covers them; what it is owed is carried on,
across windows and partitions. Quantum k of queue s is thus due when ``(k + 1) / weight`` is reached,
and the tokens packed before it are, for every other queue, those of its quanta that are due earlier.
So the place of any token follows from its place in its queue and the queues' lengths: windows are
filled in parallel, without a gap, each with the target shares up to one quantum of each queue; when
a queue has run dry the others share its place. Ties go to the queue first in order.

A token's place in its queue is a running sum that each task keeps for its own documents, plus the sums
of the tasks before it: a hot source is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import spread, stored
from martlet.llm.tokens import VOCABULARY, token_ids
from martlet.session import setting
from martlet.sizing import lookup_join

LENGTH = 2048
QUANTUM = 128
END = 1
_UNITS = 1 << 16  # resolution of weights
_BATCH = 100  # documents that a task passes between Spark and Python at a time; their buffers are outside the heap


def _tokenise(path: str, end: int, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sums = TaskContext.get().partitionId(), {}
        for batch in batches:
            for begin in range(0, batch.num_rows, _BATCH):
                part = batch.slice(begin, _BATCH)
                ids, sizes, before = [], [], []
                for text, queue in zip(part["text"].to_pylist(), part["queue"].to_pylist()):
                    found = token_ids(text, path, added) if text else np.zeros(0, "<u4")
                    ids.append(found.tobytes() + int(end).to_bytes(4, "little"))
                    sizes.append(len(found) + 1)
                    before.append(sums.get(queue, 0))
                    sums[queue] = before[-1] + sizes[-1]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["queue"], pa.array([task] * len(ids), pa.int32()),
                     pa.array(before, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "queue", "task", "before", "tokens", "ids"])
    return run


def integer_weights(lengths: list[int], weights: list[float] | None) -> list[int]:
    """Weights as small integers, so that every task orders the quanta in exactly one way."""
    values = [float(x) for x in (lengths if weights is None else weights)]
    most = max(values, default=1.0) or 1.0
    return [max(1, round(v / most * _UNITS)) for v in values]


def places(queue: int, quanta: np.ndarray, lengths: np.ndarray, weights: np.ndarray, quantum: int) -> np.ndarray:
    """Tokens packed before each of the ``quanta`` of a queue."""
    total = quanta * quantum
    for other in range(len(lengths)):
        if other != queue:
            due = (quanta + 1) * weights[other] - (other > queue)
            total = total + np.minimum(due // weights[queue] * quantum, lengths[other])
    return total


def pieces(queue: int, start: int, size: int, lengths, weights, quantum: int, length: int) -> np.ndarray:
    """Rows (start in the document, tokens, place) of a document at ``start`` of its queue.

    A piece ends where the document, a quantum whose successor is not adjacent, or a window ends.
    """
    quanta = np.arange(start // quantum, (start + size - 1) // quantum + 1)
    first = np.maximum(quanta * quantum, start)
    last = np.minimum((quanta + 1) * quantum, start + size)
    at = places(queue, quanta, lengths, weights, quantum) + first - quanta * quantum
    new = np.concatenate(([True], at[1:] != at[:-1] + (last - first)[:-1]))
    heads = np.flatnonzero(new)
    first, at = first[heads], at[heads]
    size_of = np.add.reduceat(last - np.maximum(quanta * quantum, start), heads)
    windows = (at + size_of - 1) // length - at // length + 1
    index = np.repeat(np.arange(len(at)), windows)
    step = np.arange(len(index)) - np.repeat(np.cumsum(windows) - windows, windows)
    low = np.maximum(at[index], (at[index] // length + step) * length)
    high = np.minimum(at[index] + size_of[index], (at[index] // length + step + 1) * length)
    return np.stack([first[index] - start + low - at[index], high - low, low], 1)


def _cut(queues: list[str], lengths: list[int], weights: list[int], quantum: int, length: int):
    """Arrays of :func:`pieces` from columns queue, start and tokens: the ids are not needed to know where they go."""
    number = {q: i for i, q in enumerate(queues)}

    def run(queue: pa.Array, start: pa.Array, tokens: pa.Array) -> pa.Array:
        size, weight = np.array(lengths, np.int64), np.array(weights, np.int64)
        cuts = [pieces(number[q], at, n, size, weight, quantum, length)
                for q, at, n in zip(queue.to_pylist(), start.to_pylist(), tokens.to_pylist())]
        rows = np.concatenate([np.zeros((0, 3), np.int64), *cuts])
        ends = np.cumsum([0, *map(len, cuts)])
        found = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], ["start", "length", "place"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)
    return run


def pack(
    docs: DataFrame, weights: dict[str, float] | None = None, length: int = LENGTH, quantum: int = QUANTUM,
    path: str = VOCABULARY, end: int = END, added: bool = False,
) -> DataFrame:
    """Pieces of all documents: doc_id, queue, start, length, ids, doc_tokens, sequence_id, offset.

    A document is the ids of its text and ``end``; a null or empty text is ``end`` alone. Strings of the
    vocabulary's added tokens are ordinary text, or with ``added`` their own ids. Its queue is its source, null included (named ``\\0``). ``weights``
    are target shares by source (0 or missing: the smallest share); by default the sources' own shares
    of all tokens, so that all queues run dry together. Every id is in exactly one piece, and all windows
    but the last are full. ``ids`` are little-endian unsigned 32-bit numbers. Equal rows are packed each.
    Other columns are not read; an empty table gives an empty result. The number of sources must fit
    the driver: one length each.
    """
    if length < 1 or quantum < 1:
        raise ValueError("length and quantum are at least 1")
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    rows = spread(docs).select("doc_id", "text", F.coalesce(F.col("source").cast("string"), F.lit("\u0000")).alias("queue"))
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(_BATCH)):
        base = stored(rows.mapInArrow(
            _tokenise(path, end, added), f"doc_id {doc_id}, queue string, task int, before long, tokens long, ids binary"))
    per_task = base.groupBy("queue", "task").agg(F.sum("tokens").alias("tokens"))
    earlier = F.sum("tokens").over(
        Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stored(per_task.select("queue", "task", F.coalesce(earlier, F.lit(0)).alias("earlier")))
    totals = sorted(tuple(r) for r in base.groupBy("queue").agg(F.sum("tokens")).collect())  # a row for each source
    queues, lengths = [q for q, _ in totals], [n for _, n in totals]
    shares = integer_weights(lengths, None if weights is None else [weights.get(q, 0.0) for q in queues])
    placed = lookup_join(base, offsets, ["queue", "task"]).withColumn("start", F.col("before") + F.col("earlier"))
    cut = F.arrow_udf(
        _cut(queues, lengths, shares, quantum, length), "array<struct<start: bigint, length: bigint, place: bigint>>")
    cuts = placed.select("doc_id", "queue", "tokens", "ids", cut("queue", "start", "tokens").alias("cut"))
    own = cuts.select("doc_id", "queue", "tokens", F.explode(F.transform("cut", lambda c: F.struct(
        c["start"].alias("start"), c["length"].alias("length"), c["place"].alias("place"),
        F.substring("ids", (4 * c["start"] + 1).cast("int"), (4 * c["length"]).cast("int")).alias("ids")))).alias("p"))
    return own.select(
        "doc_id", "queue", "p.start", "p.length", "p.ids", F.col("tokens").alias("doc_tokens"),
        F.expr(f"p.place div {length}").alias("sequence_id"), (F.col("p.place") % length).alias("offset"))


def digest(packed: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "queue")
