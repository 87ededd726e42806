"""Jaccard self-join of documents on word n-grams by a partitioned prefix tree.

Sets are kept in one global order of n-grams: frequent ones last, else by hash. Two sets that link
share an n-gram among the first ``|x| - ceil(t |x|) + 1`` of each, so the tree's branches below an
n-gram are independent of each other, and only branches that two different sets enter are kept.

* The order's frequent class is a bit array of fixed size (``ORDER_BITS``) over hashes of n-grams met
  often among first n-grams. It only decides the order: any state of it gives the same links.
* In each branch the sets are compared with one of them first, the branch's pivot. A pivot's partners
  are cut into blocks; in a block they are put in a radix tree that the pivot's set walks down:
  overlaps of shared stretches are counted once, and a subtree is left as soon as overlap plus
  what remains of either side cannot reach the threshold.
* Sets already known to be in one component need no further comparison. Rounds with other pivots
  follow while many pairs across components are left; then all pairs that are left are compared, so
  no link between components is lost, whatever the groups look like.
* Pairs are filtered by length, by the places of their shared n-gram, and by the parities of their
  n-grams in ``CLASSES`` classes: every parity that differs is an n-gram that only one of them has.

Copies (equal sets) are one member from the start. Hot n-grams are hot keys of joins, which adaptive
execution splits; no branch is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import drop, numbered, spread, stored
from martlet.llm.components import components
from martlet.llm.shingles import shingle_set
from martlet.sizing import lookup_join

ORDER_BITS = 1 << 24  # 2 MB for each task, at any input size
FREQUENT = 8
BLOCK = 256
CLASSES = 512


class Order:
    """Global order of n-grams: those whose bit is set last, else by hash."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def last(self, grams: np.ndarray) -> np.ndarray:
        at = (grams % np.uint64(len(self.bits) * 8)).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

    def sort(self, grams: np.ndarray) -> np.ndarray:
        last = self.last(grams)
        return np.concatenate((grams[~last], grams[last]))


def _first(size, num: int, den: int):
    """How many n-grams of a set of ``size`` come first: two sets that link share one of those of each."""
    return size + (-num * size) // den + 1


def _stored_of(size, num: int, den: int):
    """How many of the smallest n-grams are kept beside a set's key: more than come first, as some may be moved last."""
    first = _first(size, num, den)
    return np.minimum(size, first + first // 8 + 12)


def _keys(words: int, num: int, den: int):
    """Hash and size of each whole set, and its smallest n-grams, so that texts need not be cut up again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low, sizes, heads = [], [], [], []
            for data in batch["data"].to_pylist():
                grams = shingle_set(data, words)
                key = xxhash.xxh3_128_intdigest(grams.tobytes()) if len(grams) else None
                high.append(None if key is None else (key >> 64) - (1 << 63))
                low.append(None if key is None else (key & ((1 << 64) - 1)) - (1 << 63))
                sizes.append(len(grams))
                heads.append(grams[:_stored_of(len(grams), num, den)].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["doc_id"], pa.array(high, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(heads, pa.binary())],
                ["row", "doc_id", "high", "low", "size", "head"])
    return run


HEADS = "row long, low long, size long, head binary"


def _whole_heads(words: int):
    """Rows like those of :func:`_keys` that hold whole sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [shingle_set(data, words).tobytes() for data in batch["data"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["low"], batch["size"], pa.array(heads, pa.binary())], ["row", "low", "size", "head"])
    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of a batch's heads, and how many each has."""
    heads = column.to_pylist()
    return np.frombuffer(b"".join(heads), np.uint64), np.array([len(h) // 8 for h in heads], np.int64)


def _smallest(num: int, den: int):
    """The n-grams that would come first in the order of their hashes alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, held = _flat(batch["head"])
            first = _first(batch["size"].to_numpy(), num, den)
            place = np.arange(len(grams)) - np.repeat(np.cumsum(held) - held, held)
            yield pa.RecordBatch.from_arrays([pa.array(grams[place < np.repeat(first, held)].view(np.int64))], ["gram"])
    return run


def _places(batch: pa.RecordBatch, num: int, den: int, ranks: Order):
    """(n-grams, row of the batch, place in the order) of those that come first, and the rows whose head is too short."""
    grams, held = _flat(batch["head"])
    size = batch["size"].to_numpy()
    first = _first(size, num, den)
    of = np.repeat(np.arange(len(held)), held)
    early = ~ranks.last(grams)
    before = np.concatenate(([0], np.cumsum(early)))
    start = np.cumsum(held) - held
    place = before[:-1] - np.repeat(before[start], held)
    front = before[start + held] - before[start]
    lacking = np.flatnonzero(front < first)
    take = early & (place < first[of])
    whole = held == size
    if len(lacking):  # those n-grams that the order puts last fill up whole sets
        rank = np.arange(len(grams)) - np.repeat(start, held) - place + front[of]
        fill = ~early & (whole & (front < first))[of] & (rank < first[of])
        place = np.where(early, place, rank)
        take |= fill
    short = lacking[~whole[lacking]]
    if len(short):
        take &= ~np.isin(of, short)
    return grams[take].view(np.int64), of[take], place[take], short


def _short_rows(num: int, den: int, order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Order(order.value)
        for batch in batches:
            short = pa.array(_places(batch, num, den, ranks)[3])
            yield pa.RecordBatch.from_arrays([batch[c].take(short) for c in ("row", "low", "size")], ["row", "low", "size"])
    return run


def _first_grams(num: int, den: int, order, keyed: bool):
    """First n-grams with the hash of the whole set, or with the set's number, size and the place in the order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Order(order.value)
        for batch in batches:
            grams, of, place, _ = _places(batch, num, den, ranks)
            if keyed:
                yield pa.RecordBatch.from_arrays([pa.array(grams), batch["low"].take(pa.array(of))], ["gram", "key"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams), batch["row"].take(pa.array(of)), pa.array(batch["size"].to_numpy()[of].astype(np.int32)),
                     pa.array(place.astype(np.int32))], ["gram", "row", "size", "place"])
    return run


def _whole_sets(words: int, order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Order(order.value)
        for batch in batches:
            sets, odd = [], []
            for data in batch["data"].to_pylist():
                grams = shingle_set(data, words)
                sets.append(ranks.sort(grams).tobytes())
                counts = np.bincount((grams % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES)
                odd.append(np.packbits((counts & 1).astype(np.uint8)).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(sets, pa.binary()), pa.array(odd, pa.list_(pa.int64()))],
                ["row", "grams", "odd"])
    return run


def frequent_order(heads: DataFrame, num: int, den: int):
    """Broadcast bit array of n-grams that many sets have among their first; of fixed size."""
    spark = heads.sparkSession
    often = (
        heads.select("size", "head").mapInArrow(_smallest(num, den), "gram long")
        .groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FREQUENT))
    # The unsigned remainder of the hash, as in Order; one row for each 64-bit word of the array.
    bit = F.pmod(F.col("gram"), F.lit(ORDER_BITS))
    words64 = (
        often.groupBy((F.floor(bit / 64)).cast("int").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(gram, {ORDER_BITS}) % 64 as int))")).alias("mask")))
    bits = np.zeros(ORDER_BITS // 64, np.int64)
    found = stored(words64).toArrow()  # ORDER_BITS / 64 rows at most
    bits[found["word"].to_numpy()] = found["mask"].to_numpy()
    return spark.sparkContext.broadcast(bits.view(np.uint8))


def tree_overlaps(sets: list[np.ndarray], probe: np.ndarray, rank, needed: list[int]) -> list[bool]:
    """Which of ``sets`` share at least ``needed`` n-grams with ``probe``, by one walk down their tree.

    ``sets`` and ``probe`` are in the same order; ``rank`` gives, for an array of n-grams, how many
    of the probe's come before or at each.
    """
    by_path = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
    paths = [sets[i] for i in by_path]
    found = [False] * len(sets)
    shared = []  # n-grams that a path has in common with the next
    for a, b in zip(paths, paths[1:]):
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        shared.append(int(differ[0]) if len(differ) else n)
    members = np.sort(probe)

    def inside(part: np.ndarray) -> int:
        at = np.searchsorted(members, part)
        at[at == len(members)] = 0
        return int(np.count_nonzero(members[at] == part)) if len(members) else 0

    stack = [(0, len(paths), 0, 0)]
    while stack:
        low, high, depth, overlap = stack.pop()
        end = min([len(paths[low]), *shared[low:high - 1]]) if high - low > 1 else len(paths[low])
        if end > depth:  # the stretch that all paths of this subtree share
            overlap += inside(paths[low][depth:end])
            left = len(probe) - rank(paths[low][end - 1])
        else:
            left = len(probe) - (rank(paths[low][end - 1]) if end else 0)
        alive = [
            i for i in range(low, high)
            if overlap + min(left, len(paths[i]) - end) >= needed[by_path[i]]]
        if not alive:
            continue
        if high - low == 1:
            found[by_path[low]] = overlap >= needed[by_path[low]]
            continue
        begin = low
        for i in range(low, high):  # children part where the shared stretch ends
            if i == high - 1 or shared[i] <= end:
                if i == begin and len(paths[i]) == end:
                    found[by_path[i]] = overlap >= needed[by_path[i]]
                else:
                    stack.append((begin, i + 1, end, overlap))
                begin = i + 1
    return found


def _compare(num: int, den: int, order):
    def run(table: pa.Table) -> pa.Table:
        ranks = Order(order.value)
        is_probe = table["is_probe"].to_pylist()
        arrays = [np.frombuffer(x, np.uint64) for x in table["grams"].to_pylist()]
        probe = arrays[is_probe.index(True)]
        sets = [a for a, own in zip(arrays, is_probe) if not own]
        last = ranks.last(probe)
        early, late = probe[~last], probe[last]

        def rank(gram) -> int:
            if ranks.last(np.array([gram]))[0]:
                return len(early) + int(np.searchsorted(late, gram, "right"))
            return int(np.searchsorted(early, gram, "right"))

        needed = [-(-num * (len(s) + len(probe)) // (num + den)) for s in sets]
        keep = tree_overlaps(sets, probe, rank, needed)
        partners = table.filter(pa.array([not own for own in is_probe]))
        return pa.table({"x": partners["row"], "p": partners["p"]}).filter(pa.array(keep, pa.bool_()))
    return run


def compare(pairs: DataFrame, sets: DataFrame, num: int, den: int, order) -> DataFrame:
    """Those of the pairs (x, p) whose sets reach the threshold; a pivot's partners come in blocks.

    The sets are read once, and only those of the pairs are moved to the blocks.
    """
    block = F.pmod(F.xxhash64("x"), F.greatest(F.lit(1), F.ceil(F.col("partners") / BLOCK))).cast("long")
    partners = pairs.groupBy("p").agg(F.count(F.lit(1)).alias("partners"))
    blocks = pairs.join(partners, "p").withColumn("block", block)
    uses = stored(
        blocks.select(F.col("x").alias("row"), "p", "block", F.lit(False).alias("is_probe"))
        .union(blocks.select(F.col("p").alias("row"), "p", "block", F.lit(True)).distinct()))
    found = stored(
        sets.select("row", "grams").join(uses, "row").groupBy("p", "block")
        .applyInArrow(_compare(num, den, order), "x long, p long"))
    drop(uses)
    return found


def _may_link(num: int, den: int) -> Column:
    """Lengths allow a link, and so does the least number of n-grams that only one of the two has."""
    a, b = F.col("size"), F.col("p_size")
    differ = F.aggregate(
        F.zip_with("odd", "p_odd", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, v: s + v)
    return (den * F.least(a, b) >= num * F.greatest(a, b)) & (differ * (num + den) <= (den - num) * (a + b))


def _pairs_across(named: DataFrame, counts: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs of different components in each open branch that may link.

    Left of the n-gram that brings two sets together first, they share nothing: what remains of the
    shorter rest bounds their overlap.
    """
    mine = stored(named.join(counts.select("gram"), "gram"))
    other = mine.select("gram", *[F.col(c).alias(f"p_{c}") for c in ("row", "root", "size", "place", "odd")])
    left = F.least(F.col("size") - F.col("place"), F.col("p_size") - F.col("p_place"))
    return (
        mine.join(other, (mine["gram"] == other["gram"]) & F.expr("row > p_row AND root <> p_root")
                  & (left * (num + den) >= num * (F.col("size") + F.col("p_size"))) & _may_link(num, den))
        .select(F.col("row").alias("x"), F.col("p_row").alias("p")).distinct())


def _pairs_with_pivots(named: DataFrame, counts: DataFrame, num: int, den: int, turn: int) -> DataFrame:
    """Members of each open branch with one of them.

    That is first the one with the fewest n-grams of its own, which a group of copies is likely to be made
    from; in later turns the smallest hash with the turn.
    """
    by = F.struct("own", "row") if turn == 0 else F.struct(F.xxhash64("row", F.lit(turn)), F.col("row"))
    pivots = stored(
        named.join(counts.select("gram"), "gram")
        .groupBy("gram").agg(F.min(F.struct(by.alias("by"), "root", "size", "odd")).alias("o"))
        .select(F.col("gram").alias("p_gram"), F.col("o.by.row").alias("p_row"), F.col("o.root").alias("p_root"),
                F.col("o.size").alias("p_size"), F.col("o.odd").alias("p_odd")))
    return (
        named.join(pivots, (F.col("gram") == F.col("p_gram")) & F.expr("row <> p_row AND root <> p_root")
                   & _may_link(num, den))
        .select(F.col("row").alias("x"), F.col("p_row").alias("p")).distinct())


def link(base: DataFrame, keyed: DataFrame, keys: DataFrame, words: int, num: int, den: int, owned: bool) -> DataFrame:
    """(node, root) of components of linked sets, one node for each different set; others are alone.

    ``keyed`` is ``keys`` with heads. It is deleted as soon as it has been used, as is a base that is ``owned``.
    """
    heads = keyed.where("size > 0").select("row", "low", "size", "head")
    order = frequent_order(heads, num, den)
    # Sets with so many frequent n-grams that the stored ones do not reach are cut up once more.
    short = stored(heads.mapInArrow(_short_rows(num, den, order), "row long, low long, size long"))
    again = stored(
        lookup_join(base.select("row", "data"), short, "row").mapInArrow(_whole_heads(words), HEADS))
    heads = heads.unionAll(again)  # too short a head of the first is passed over
    branches = stored(
        heads.mapInArrow(_first_grams(num, den, order, True), "gram long, key long")
        .groupBy("gram").agg(F.min("key").alias("a"), F.max("key").alias("b"))
        .where("a <> b").select("gram"))
    one = keys.where("size > 0").groupBy("high", "low").agg(F.min("row").alias("row")).select("row")
    found = stored(
        heads.mapInArrow(_first_grams(num, den, order, False), "gram long, row long, size int, place int")
        .join(branches, "gram").join(one, "row", "left_semi"))
    drop(branches, short, again, keyed)
    sets = stored(
        base.join(found.select("row").distinct(), "row").select("row", "data")
        .mapInArrow(_whole_sets(words, order), "row long, grams binary, odd array<long>"))
    if owned:
        drop(base)
    first = F.col("size") - F.ceil(F.col("size") * num / den) + 1
    own = found.groupBy("row").agg((F.max(first) - F.count(F.lit(1))).alias("own"))
    entries = stored(found.join(sets.select("row", "odd").join(own, "row"), "row"))
    drop(found)
    links = stored(entries.select(F.col("row").alias("a"), F.col("row").alias("b")).limit(0))
    labels = components(links)
    rows, before, turn, last = entries.count(), None, 0, False
    while not last:
        named = stored(
            entries.join(labels.withColumnRenamed("node", "row"), "row", "left")
            .withColumn("root", F.coalesce("root", "row")))
        sizes = named.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("n"))
        counts = stored(
            sizes.groupBy("gram").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"))
            .where("n * n > same"))
        # Pairs across components that are still open; pivots go on as long as they settle most of them.
        left = counts.agg(F.sum(F.col("n") * F.col("n") - F.col("same"))).first()[0] or 0
        last = left <= 4 * rows or (before is not None and 2 * left > before)
        pairs = stored(
            _pairs_across(named, counts, num, den) if last else _pairs_with_pivots(named, counts, num, den, turn))
        found = compare(pairs, sets, num, den, order)
        more = stored(links.union(found.select(F.col("x").alias("a"), F.col("p").alias("b"))))
        drop(links, found, pairs, named, counts)
        links, labels, before, turn = more, components(more), left, turn + 1
    drop(entries, sets)
    return labels


def classes_of(base: DataFrame, words: int, num: int, den: int, owned: bool) -> DataFrame:
    """:func:`similar_classes` of stored and numbered rows (row, doc_id, data)."""
    doc_id = base.schema["doc_id"].dataType.simpleString()
    keyed = stored(base.select("row", "doc_id", "data").mapInArrow(
        _keys(words, num, den), f"row long, doc_id {doc_id}, high long, low long, size long, head binary"))
    keys = stored(keyed.drop("head"))
    labels = link(base, keyed, keys, words, num, den, owned)
    named = keys.where("size > 0")
    sets = named.groupBy("high", "low").agg(
        F.min("row").alias("node"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    rooted = stored(sets.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node")))
    smallest = stored(rooted.groupBy("root").agg(F.min("first").alias("least")))
    classes = stored(rooted.join(smallest, "root").select("high", "low", "least"))
    drop(rooted, smallest)
    linked = (
        named.join(classes, ["high", "low"])
        .select("row", "doc_id", F.col("size").alias("n_shingles"), F.col("least.doc_id").alias("component_id"),
                (F.col("least.row") == F.col("row")).alias("leader")))
    alone = keys.where("size = 0").select(
        "row", "doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.lit(True).alias("leader"))
    return linked.union(alone)


def _check(num: int, den: int) -> None:
    if not 0 < num <= den:
        raise ValueError("the threshold is above 0 and at most 1")


def similar_classes(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per row of ``docs``: row, doc_id, n_shingles, component_id, leader.

    A document's set is its distinct shingles of ``words`` words (lower-cased A-Z, split at ASCII white
    space); with fewer words, the whole sequence. Two sets link when den * |intersection| >= num * |union|.
    component_id is the smallest doc_id reachable by links; leader marks one row of each class, the first
    with that doc_id. A null or wordless text has no shingles and is linked with nothing: its own doc_id,
    leader. Equal rows are linked like any copies. Null doc_ids never name a class with another doc_id.
    Other columns are not read; an empty table gives an empty result.
    """
    _check(num, den)
    base = numbered(spread(docs), F.col("doc_id"), F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")).alias("data"))
    return classes_of(base, words, num, den, owned=True)


def distinct_documents(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Rows of ``docs``, all columns, without those that :func:`similar_classes` links to a leader."""
    _check(num, den)
    whole = numbered(spread(docs), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    base = whole.select("row", "doc.doc_id", F.coalesce(F.encode("doc.text", "UTF-8"), F.lit(b"")).alias("data"))
    leaders = classes_of(base, words, num, den, owned=False).where("leader").select("row")
    return whole.join(leaders, "row").select("doc.*")
