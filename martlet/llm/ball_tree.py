"""Exact ranked lexical search by sparse ball trees and centroid-radius bounds.

A document is a sparse vector over the terms of the searched items: the whole-number impact of each term in it.
A score is the inner product with the weights of an item's terms. Documents with the same rarest term are brought
together and cut into blocks; each block is a ball tree, halved between two documents far from each other
down to leaves of ``LEAF`` documents. A node keeps its centroid and, for each group of coordinates, the largest distance
of a document from it. By the Cauchy-Schwarz inequality in each group, no document below a node scores more than

    sum over groups of  query . centroid  +  |query| * radius.

Bounds are rounded up: radii hold room for the rounding of their squares, and a bound is raised by more than its
own rounding before it is compared. Nodes are opened in order of their bounds, and a subtree that cannot reach the
k-th best score so far is left; documents of the leaves that are opened are scored in whole numbers. A first
pass that scores one leaf of each tree gives every item a k-th score to begin with.

Items are handled in blocks of bounded size, which are all that is sent to every task.
"""

from __future__ import annotations

import heapq
import io
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import drop, spread, stored

TERMS = 1 << 20  # terms of items, repeated ones included, that are searched at a time and sent to every task
DOCUMENTS = 1024  # documents of a tree
ENTRIES = 1 << 18  # and their terms, from which on a tree is closed
LEAF = 32
GROUP = 4  # coordinates whose distances share a radius; with all in one, leaves are hardly ever left out
_PIECE = 1 << 20  # bytes of a text split at a time
_ROOM = 1e-12  # share of the squares that a radius may lose to rounding
_UP = 1 + 1e-6  # by how much bounds are raised; centroids are kept in single precision
# Letters A-Z become lower case; bytes that no term holds become spaces.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    begin = 0
    while begin < len(data):
        end = begin + _PIECE
        part = data[begin:end].translate(_TABLE)
        while end < len(data) and not part.endswith(b" "):  # not within a term
            more = data[end:end + _PIECE].translate(_TABLE)
            at = more.find(b" ")
            cut = len(more) if at < 0 else at + 1
            part, end = part + more[:cut], end + cut
        yield part.split()
        begin = end


def _weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Impact of a term that occurs ``tf`` times among ``n``; whole numbers throughout."""
    if len(n) and 90 * int(n.max()) * documents >= 1 << 63:
        m = np.array([10 + 90 * int(x) * documents // length for x in n], np.int64)
    else:
        m = 10 + 90 * n * documents // max(length, 1)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each range in turn."""
    total = int(sizes.sum())
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


class Tree:
    """A ball tree of a block's documents; its parts are plain arrays, so that it can be stored."""

    FIELDS = ("local", "lo", "hi", "child", "radii", "centre_at", "centre_node", "centre", "ptr", "term", "impact", "rows", "ids", "group")

    def __init__(self, **parts: np.ndarray):
        self.__dict__.update(parts)

    @staticmethod
    def build(rows, ids, sizes, terms, impact, weights, leaf: int = LEAF, group: int = GROUP) -> Tree:
        """Tree of documents given by number of entries, their terms (ascending) and impacts; ``weights`` of all terms."""
        local, term = np.unique(terms, return_inverse=True)
        width, groups = len(local), -(-len(local) // group)
        # Half of a weight's root is put on either side: rare terms then decide which documents are far apart.
        value = impact * np.sqrt(weights[local][term])
        start = np.concatenate(([0], np.cumsum(sizes)))
        perm = np.arange(len(sizes))
        lo, hi, child, radii, centres = [], [], [], [], []
        todo = [(0, len(sizes), -1)]
        while todo:
            low, high, parent = todo.pop()
            node = len(lo)
            lo.append(low), hi.append(high), child.append([-1, -1])
            if parent >= 0:
                child[parent][child[parent][0] >= 0] = node
            own, n = perm[low:high], high - low
            at = _ranges(start[own], sizes[own])
            doc, t, v = np.repeat(np.arange(n), sizes[own]), term[at], value[at]
            mean = np.bincount(t, v, width) / n
            places = np.flatnonzero(mean)
            centres.append((places, np.full(len(places), node), mean[places]))
            g = t // group
            first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (g[1:] != g[:-1]))))
            squares, change = v * v, v * v - 2 * v * mean[t]
            middle = np.bincount(np.arange(width) // group, mean * mean, groups)
            of = g[first]
            apart = np.add.reduceat(change, first) + middle[of]
            apart += _ROOM * (np.add.reduceat(squares, first) + middle[of])
            far = np.zeros(groups)
            np.maximum.at(far, of, apart)
            lacking = np.bincount(of, minlength=groups) < n
            far[lacking] = np.maximum(far[lacking], middle[lacking] * (1 + _ROOM))
            radii.append(np.sqrt(far))
            if n <= leaf:
                continue
            length = np.bincount(doc, squares, n)
            a = int(np.argmax(np.bincount(doc, change, n)))
            one = np.zeros(width)
            one[t[doc == a]] = v[doc == a]
            b = int(np.argmax(length - 2 * np.bincount(doc, v * one[t], n)))
            one[t[doc == b]] -= v[doc == b]
            perm[low:high] = own[np.argsort(np.bincount(doc, v * one[t], n), kind="stable")]
            todo += [(low, low + n // 2, node), (low + n // 2, high, node)]
        at = _ranges(start[perm], sizes[perm])
        places, nodes, values = (np.concatenate(c) for c in zip(*centres))
        order = np.lexsort((nodes, places))
        return Tree(
            local=local.astype(np.int32), lo=np.array(lo, np.int32), hi=np.array(hi, np.int32), child=np.array(child, np.int32),
            radii=np.array(radii), centre_at=np.searchsorted(places[order], np.arange(width + 1)).astype(np.int32),
            centre_node=nodes[order].astype(np.int16 if len(lo) < 1 << 15 else np.int32),
            centre=values[order].astype(np.float32), ptr=np.concatenate(([0], np.cumsum(sizes[perm]))),
            term=term[at].astype(np.int32), impact=impact[at].astype(np.int32), rows=rows[perm], ids=ids[perm], group=np.array(group))

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as parts:
            return Tree(**{f: parts[f] for f in Tree.FIELDS})

    def bounds(self, place: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What no document below each node exceeds, for a query's terms by their local place."""
        root = np.sqrt(weight.astype(np.float64))
        sizes = self.centre_at[place + 1] - self.centre_at[place]
        at = _ranges(self.centre_at[place], sizes)
        middle = np.bincount(self.centre_node[at], self.centre[at] * np.repeat(root, sizes), len(self.lo))
        own, of = np.unique(place // int(self.group), return_inverse=True)
        return (middle + self.radii[:, own] @ np.sqrt(np.bincount(of, weight))) * _UP + 1

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int, leaves: int | None = None):
        """(rows, ids, scores) of the first ``k`` documents of at least ``least``, and the number of scored leaves.

        ``terms`` are the query's, ascending. With ``leaves`` the search ends after as many.
        """
        place = np.minimum(np.searchsorted(self.local, terms), len(self.local) - 1)
        known = self.local[place] == terms
        place, weight = place[known], weights[known]
        rows, ids, scores, scored = (np.zeros(0, np.int64),) * 3 + (0,)
        if not len(place):
            return rows, ids, scores, scored
        bounds = self.bounds(place, weight)
        query = np.zeros(len(self.local), np.int64)
        query[place] = weight
        least, heap = max(least, 1), [(-bounds[0], 0)]
        while heap and (leaves is None or scored < leaves):
            bound, node = heapq.heappop(heap)
            if -bound < least:
                break
            if self.child[node, 0] >= 0:
                for c in self.child[node].tolist():
                    # A child's own bound, or its parent's where that is lower.
                    heapq.heappush(heap, (max(bound, -bounds[c]), c))
                continue
            scored += 1
            low, high = self.lo[node], self.hi[node]
            begin, end = self.ptr[low], self.ptr[high]
            found = np.add.reduceat(query[self.term[begin:end]] * self.impact[begin:end], self.ptr[low:high] - begin)
            near = np.flatnonzero(found >= least)
            if not len(near):
                continue
            rows, ids = (np.concatenate((a, b[low:high][near])) for a, b in ((rows, self.rows), (ids, self.ids)))
            scores = np.concatenate((scores, found[near]))
            if len(scores) > k:
                best = np.lexsort((rows, ids, -scores))[:k]
                rows, ids, scores = rows[best], ids[best], scores[best]
            if len(scores) == k:
                least = max(least, int(scores.min()))
        return rows, ids, scores, scored


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [x or b"" for x in batch["text"].cast(pa.binary()).to_pylist()]
        terms = [list(dict.fromkeys(t for part in terms_of(x) for t in part)) for x in texts]
        yield pa.RecordBatch.from_arrays(
            [batch["item"], batch["item_id"], pa.array(terms, pa.list_(pa.binary())),
             pa.array([len(x) for x in terms], pa.int64())], ["item", "item_id", "terms", "n"])


def _document_vectors(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = vocabulary.value
        for batch in batches:
            sizes, terms, counts = [], [], []
            for data in batch["text"].cast(pa.binary()).to_pylist():
                found: Counter = Counter()
                size = 0
                for part in terms_of(data or b""):
                    size += len(part)
                    found.update(part)
                own = sorted((known[t], found[t]) for t in found.keys() & known.keys())
                sizes.append(size)
                terms.append([t for t, _ in own])
                counts.append([n for _, n in own])
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], ["row", "doc_id", "n", "terms", "counts"])
    return run


def _with_impacts(documents: int, length: int, weights):
    """Documents with the impacts of their terms, and the rarest of these terms (the first, if some are equal)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = weights.value
        for batch in batches:
            terms, sizes = batch["terms"].flatten().to_numpy(), batch["terms"].value_lengths().to_numpy()
            n = np.repeat(batch["n"].to_numpy(), sizes)
            impact = impacts(batch["counts"].flatten().to_numpy(), n, documents, length)
            start = np.concatenate(([0], np.cumsum(sizes)))
            lead = [int(terms[a:b][np.argmax(weight[terms[a:b]])]) for a, b in zip(start, start[1:])]
            lists = pa.ListArray.from_arrays(pa.array(start, pa.int32()), pa.array(impact, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["doc_id"], pa.array(lead, pa.int32()), batch["terms"], lists],
                ["row", "doc_id", "lead", "terms", "impacts"])
    return run


_NO_ID = np.iinfo(np.int64).max  # stands for a null id: behind all others


def _trees(weights, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, docs, entries = [], 0, 0

        def close():
            table = pa.Table.from_batches(open_).combine_chunks().to_batches()[0]
            ids = table["doc_id"].fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            tree = Tree.build(
                table["row"].to_numpy(), ids.astype(np.int64), table["terms"].value_lengths().to_numpy().astype(np.int64),
                table["terms"].flatten().to_numpy(), table["impacts"].flatten().to_numpy(), weights.value)
            return pa.RecordBatch.from_arrays([pa.array([tree.dump()], pa.binary())], ["tree"])

        for batch in batches:
            sizes = np.cumsum(batch["terms"].value_lengths().to_numpy().astype(np.int64))
            begin = 0
            while begin < batch.num_rows:
                before = int(sizes[begin - 1]) if begin else 0
                room = int(np.searchsorted(sizes, before + ENTRIES - entries, "right")) - begin
                take = min(max(room, 0 if docs else 1), most - docs, batch.num_rows - begin)
                if take:
                    open_.append(batch.slice(begin, take))
                    docs, begin = docs + take, begin + take
                    entries += int(sizes[begin - 1]) - before
                if docs and (docs >= most or begin < batch.num_rows):
                    yield close()
                    open_, docs, entries = [], 0, 0
        if docs:
            yield close()
    return run


def _search(items, k: int, leaves: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = items.value
        for batch in batches:
            for data in batch["tree"]:
                tree, found = Tree.load(data.as_py()), []
                for number, terms, weights, least in queries:
                    rows, ids, scores, _ = tree.search(terms, weights, k, least, leaves)
                    if len(rows):
                        found.append((np.full(len(rows), number), rows, ids, scores))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c)) for c in zip(*found)], ["item", "row", "id", "score"])
    return run


_FOUND = "item long, row long, id long, score long"


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each item with their rank; Spark keeps as many in each task before it shuffles them."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, wanted: list, k: int, most: int) -> DataFrame:
    """(item, row, id, score, rank) of items given as (number, terms)."""
    spark = docs.sparkSession
    numbers: dict[bytes, int] = {}
    for _, terms in wanted:  # terms of one item have neighbouring numbers, and so share groups of coordinates
        for t in terms:
            numbers.setdefault(t, len(numbers))
    vocabulary = spark.sparkContext.broadcast(numbers)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    vectors = stored(
        spread(docs.select("doc_id", "text")).withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(_document_vectors(vocabulary), f"row long, doc_id {id_type}, n long, terms array<int>, counts array<long>"))
    documents, length = vectors.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(len(numbers), np.int64)
    for r in holding.collect():  # a row for each term of these items at most
        weights[r["t"]] = _weight(documents, r["df"])
    shared = spark.sparkContext.broadcast(weights)
    found = vectors.where("size(terms) > 0").mapInArrow(
        _with_impacts(documents, length, shared),
        f"row long, doc_id {id_type}, lead int, terms array<int>, impacts array<long>")
    trees = stored(
        found.select("row", F.col("doc_id").cast("long").alias("doc_id"), "lead", "terms", "impacts")
        .repartitionByRange("lead", "row").sortWithinPartitions("lead", "row")
        .mapInArrow(_trees(shared, most), "tree binary"))
    drop(vectors)
    queries = []
    for number, terms in wanted:
        own = np.sort(np.array([numbers[t] for t in terms], np.int64))
        queries.append((number, own, weights[own]))

    def sent(least: dict[int, int]):
        return spark.sparkContext.broadcast([(*q, least.get(q[0], 1)) for q in queries])

    start = _first(trees.mapInArrow(_search(sent({}), k, 1), _FOUND), k).where(F.col("rank") == k)
    least = {r["item"]: r["score"] for r in start.select("item", "score").collect()}  # a row for each of these items
    best = stored(_first(trees.mapInArrow(_search(sent(least), k, None), _FOUND), k))
    drop(trees)
    return best


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10, documents: int = DOCUMENTS, terms: int = TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0 of each item.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, only A-Z in lower case. With N documents
    that have a term, L terms in them, n in one, and df documents that hold a term, its weight is
    floor(1000 ln((2N + 2) / (2df + 1))); a score sums weight * (10**9 tf div (1000 tf + 8m)) over the item's terms, once
    each, with m = 10 + 90 n N div L. Equal scores are in order of doc_id, a null one last. A null or empty text has no
    terms: such a document is not found, such an item finds nothing. Repeated rows count each, as documents and as
    items. Other columns are not read. No documents or no items give an empty result. The texts are read once for
    each ``terms`` terms of the items.
    """
    spark = docs.sparkSession
    numbered = items.select(
        F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("string").alias("text"))
    id_type = items.schema["item_id"].dataType.simpleString()
    wanted = stored(numbered.mapInArrow(_item_terms, f"item long, item_id {id_type}, terms array<binary>, n long"))
    total, count = wanted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    blocks = max(1, -(-total // terms))
    part = F.pmod(F.xxhash64("item"), F.lit(blocks))
    while blocks < count and wanted.groupBy(part.alias("p")).agg(F.sum("n").alias("n")).where(F.col("n") > 2 * terms).count():
        blocks *= 2
        part = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = []
    for p in range(blocks):
        own = wanted.where((part == p) & (F.col("n") > 0)).orderBy("item").select("item", "terms").collect()
        if own:
            found.append(_search_block(docs, [(r["item"], [bytes(t) for t in r["terms"]]) for r in own], k, documents))
    if not found:
        found = [spark.createDataFrame([], _FOUND + ", rank int")]
    known = reduce(DataFrame.unionAll, found).join(wanted.select("item", "item_id"), "item")
    return known.select(
        "item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("id") != int(_NO_ID), F.col("id")).alias("doc_id"), "score")


ORACLE = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), totals AS (
  SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM split WHERE len(w) > 0
), occurrences AS (
  SELECT doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM split) GROUP BY doc_id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM occurrences, totals GROUP BY term, n_docs
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM wanted JOIN occurrences USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""
