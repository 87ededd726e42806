"""Remove every byte of a document that lies in a long string occurring anywhere else.

Bucket-pointer refinement on a sparse set of suffixes. Every ``window``-byte string holds exactly one
anchor, the position of its smallest ``gram``-byte hash, and equal strings hold it at the same place;
so only suffixes at anchors (about one in 85 bytes) are bucketed, and the strings over each anchor
are told apart by refining its bucket.

1. Initial buckets: the hash of the ``gram`` bytes at an anchor. Buckets of one member are dropped.
2. Refinement by identifiers of later offsets: an anchor's strings form a range; the identifier of all
   bytes they cover splits the bucket. A part with two members is settled: all its strings repeat.
3. The others go on to blocks of ``BLOCK`` neighbouring strings. A block's core (bytes common to all
   its strings) is the next identifier: a core seen once ends the block. Equal cores with equal
   remainders settle it.
4. In what is left, the identifier of a single string is its core's identifier, reused, with the few
   bytes left and right of it.

Each step keys rows by identifier, counts with partial sums and joins back only members of parts that
are still open, so a passage in a third of all documents is a hot join key that adaptive execution
splits, never one group in one task. Identifiers are 64-bit hashes, combined with the anchor's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import drop, numbered, spread, stored

WINDOW = 200
BLOCK = 14
_LOW = np.uint64(0xFFFFF)  # place of an anchor inside a stretch of 2**20 bytes
_BYTES = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_length(window: int) -> int:
    """Largest power of two that leaves most of a window for choosing the anchor, 32 at most."""
    return min(32, 1 << max(0, (window // 4).bit_length() - 1))


def find_anchors(data: np.ndarray, window: int = WINDOW):
    """Hash and place of each anchor, and the first and last start of the windows it stands for."""
    gram, parts = gram_length(window), []
    stretch = (1 << 20) - window
    with np.errstate(over="ignore"):
        for begin in range(0, len(data) - window + 1, stretch):
            piece = data[begin:begin + stretch + window - 1]
            hashes, power, k = _BYTES[piece], np.uint64(0x9E3779B97F4A7C15), 1
            while k < gram:
                hashes = hashes[:-k] * power + hashes[k:]
                power, k = power * power, 2 * k
            hashes ^= hashes >> np.uint64(32)
            hashes *= np.uint64(0xD6E8FEB86659FD93)
            hashes ^= hashes >> np.uint64(29)
            least = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
            places, k = window - gram + 1, 1
            while 2 * k <= places:
                least, k = np.minimum(least[:-k], least[k:]), 2 * k
            if places > k:
                least = np.minimum(least[:k - places], least[places - k:])
            change = np.flatnonzero(least[1:] != least[:-1]) + 1
            first = np.concatenate(([0], change))
            at = (least[first] & _LOW).astype(np.int64)
            last = np.concatenate((change, [len(least)])) - 1
            parts.append((hashes[at].view(np.int64), at + begin, first + begin, last + begin))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    hashes, at, first, last = (np.concatenate(x) for x in zip(*parts))
    again = np.concatenate(([False], at[1:] == at[:-1]))  # one anchor on both sides of a stretch's end
    starts = np.flatnonzero(~again)
    ends = np.concatenate((starts[1:], [len(at)])) - 1
    return hashes[starts], at[starts], first[starts], last[ends]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _grams(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_anchors(np.frombuffer(x, np.uint8), window)[0] for x in batch["data"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found or [[]]).astype(np.int64))], ["gram"])
    return run


def _spans(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[] for _ in range(6)]
            for row, data in zip(batch["row"].to_pylist(), batch["data"].to_pylist()):
                hashes, at, first, last = find_anchors(np.frombuffer(data, np.uint8), window)
                ids = [
                    xxhash.xxh3_64_intdigest(data[i:j + window], a - i)
                    for a, i, j in zip(at.tolist(), first.tolist(), last.tolist())
                ]
                for column, values in zip(columns, (
                    hashes, np.array(ids, np.uint64).view(np.int64), np.full(len(at), row, np.int64), at, first, last,
                )):
                    column.append(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c or [[]]).astype(t)) for c, t in zip(columns, [np.int64] * 3 + [np.int32] * 3)],
                ["gram", "span", "row", "at", "first", "last"])
    return run


def _blocks(window: int):
    """Blocks of the anchors in ``places``: key of the core, and the bytes left and right of it."""
    names = ["row", "at", "first", "last", "open", "weight", "block", "core", "left", "right"]
    places = window - gram_length(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row, data, anchors in zip(*(batch[c].to_pylist() for c in ("row", "data", "places"))):
                for p in anchors:
                    at, first, last = p["at"], p["first"], p["last"]
                    for block in range((at - last) // BLOCK, (at - first) // BLOCK + 1):
                        near, far = block * BLOCK, min(block * BLOCK + BLOCK - 1, places)
                        core = xxhash.xxh3_64_intdigest(data[at - near:at - far + window], block)
                        out.append((
                            row, at, first, last, p["open"], p["weight"], block, _signed(core),
                            data[max(0, at - far):at - near], data[at - far + window:at - near + window]))
                if len(out) >= 20_000:
                    yield _batch(out, names)
                    out = []
            yield _batch(out, names)
    return run


_BLOCK_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(),
                pa.binary(), pa.binary()]


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _BLOCK_TYPES)], names)


def repeated_windows(base: DataFrame, window: int = WINDOW) -> DataFrame:
    """Ranges (row, first, last) of starts of windows that also start elsewhere in ``base``(row, data)."""
    count = F.count(F.lit(1))
    grams = base.select("data").mapInArrow(_grams(window), "gram long")
    # Stored, as are the other sides of joins with hot keys: a join of two plain inputs can be split.
    multiple = stored(grams.groupBy("gram").agg(count.alias("n")).where("n > 1").select("gram"))
    members = stored(
        base.select("row", "data")
        .mapInArrow(_spans(window), "gram long, span long, row long, at int, first int, last int")
        .join(multiple, "gram"))
    # Parts of a bucket with equal bytes under the whole range of strings.
    parts = stored(
        members.groupBy("gram", "span")
        .agg(count.alias("n"), F.min(F.struct("row", "at", "first", "last")).alias("one")))
    settled = members.join(parts.where("n > 1").select("gram", "span"), ["gram", "span"])
    alone = parts.where("n = 1")
    unsettled = stored(alone.select("gram").distinct())
    place = F.struct(F.col("one.at"), F.col("one.first"), F.col("one.last"), (F.col("n") == 1).alias("open"),
                     F.least("n", F.lit(2)).cast("int").alias("weight"))
    needed = (
        parts.join(unsettled, "gram")
        .groupBy(F.col("one.row").alias("row")).agg(F.collect_list(place).alias("places")))
    schema = ("row long, at int, first int, last int, open boolean, weight int, block int, core long, "
              "left binary, right binary")
    blocks = stored(base.join(needed, "row").select("row", "data", "places").mapInArrow(_blocks(window), schema))
    live = stored(
        blocks.groupBy("core").agg(F.sum("weight").alias("n"), F.max("open").alias("open"))
        .where("n > 1 AND open").select("core"))
    live_blocks = stored(blocks.join(live, "core"))
    contents = stored(
        live_blocks.groupBy("core", "block", "left", "right")
        .agg(F.sum("weight").alias("n"), F.min("open").alias("open"),
             F.min(F.struct("row", "at", "first", "last")).alias("one")))
    near = F.col("block") * BLOCK
    far = F.least(near + BLOCK - 1, F.lit(window - gram_length(window)))
    same = (
        live_blocks.where("open")
        .join(contents.where("n > 1").select("core", "block", "left", "right"), ["core", "block", "left", "right"])
        .select("row", F.greatest("first", F.col("at") - far).cast("int").alias("first"),
                F.least("last", F.col("at") - near).cast("int").alias("last")))
    # Single strings: k bytes of the left remainder and width - k of the right one round the core.
    unequal = stored(contents.where("n = 1 AND open").select("core").distinct())
    width = far - near
    k = F.col("k")
    strings = (
        contents.join(unequal, "core")
        .select("core", "left", "right", "one", (F.col("open") & (F.col("n") == 1)).alias("open"), "n", "block",
                width.alias("width"), near.alias("near"))
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("width"))))
        .where((k <= F.length("left")) & (F.col("width") - k <= F.length("right")))
        .select(
            F.xxhash64(
                "core", "block", "k",
                F.expr("CASE WHEN k = 0 THEN X'' ELSE substring(left, length(left) - k + 1, k) END"),
                F.expr("substring(right, 1, width - k)")).alias("string"),
            "n", "open", F.col("one.row").alias("row"),
            (F.col("one.at") - F.col("near") - k).cast("int").alias("start"),
            F.col("one.first").alias("first"), F.col("one.last").alias("last")))
    strings = stored(strings)
    again = stored(
        strings.groupBy("string").agg(F.sum("n").alias("n"), F.max("open").alias("open"))
        .where("n > 1 AND open").select("string"))
    single = (
        strings.where("open AND start BETWEEN first AND last").join(again, "string")
        .select("row", F.col("start").alias("first"), F.col("start").alias("last")))
    ranges = stored(settled.select("row", "first", "last").union(same).union(single))
    drop(multiple, members, parts, unsettled, blocks, live, live_blocks, contents, unequal, strings, again)
    return ranges


def _cut(window: int):
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans = [], []
            for data, ranges in zip(batch["data"].to_pylist(), batch["ranges"].to_pylist()):
                if not ranges:
                    kept.append(data)
                    spans.append([])
                    continue
                depth = np.zeros(len(data) + 1, np.int32)
                first, last = np.array([(r["first"], r["last"]) for r in ranges]).T
                np.add.at(depth, first, 1)
                np.add.at(depth, last + window, -1)
                covered = np.cumsum(depth[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0]))))
                spans.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
                kept.append(np.frombuffer(data, np.uint8)[~covered].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(x) for x in batch["data"].to_pylist()], pa.int64()),
                 pa.array(spans, span), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, spans (removed byte ranges, end exclusive), kept (bytes).

    A byte goes when a ``window``-byte string over it starts at two places of the whole input, in the
    same document or another; nothing is judged on what is left. Strings never cross documents. A null
    text is empty; a text shorter than ``window`` keeps all bytes. Equal rows count as separate
    places. Other columns are not read, and an empty table gives an empty result.
    """
    if window < 8:
        raise ValueError("a window has at least 8 bytes")
    base = numbered(spread(docs), F.col("doc_id"), F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")).alias("data"))
    ranges = repeated_windows(base, window)
    per_row = ranges.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return (
        base.join(per_row, "row", "left").select("doc_id", "data", "ranges")
        .mapInArrow(_cut(window), f"doc_id {doc_id}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"))


def digest(result: DataFrame) -> DataFrame:
    """Sizes and hash of what :func:`remove_repeats` kept."""
    return result.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
