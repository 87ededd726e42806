"""Score documents by the difference of two language models' losses per word.

A target model and a background model share one vocabulary, all words of the corpus. Both are bigram models,
interpolated with unigrams by the variety of followers, from counts over all their documents; the background is
all documents. No machine holds the counts whole, and no row stands for one bigram: documents are hashed to chunks
of text, a chunk sends its distinct words and bigrams with their counts as arrays to buckets of the words that come
first, a bucket adds up what all chunks sent it and returns the totals in the order they were asked for, and the
chunk sums the losses of its texts. The bigrams of a frequent first word, found in a sample, go to all buckets, so
that no bucket outgrows the others; a sample without it would only make one bucket larger.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import drop, stored
from martlet.llm.shingles import _BASE, _mix, word_hashes
from martlet.sizing import lookup_join

_CLASSES = 15  # unknown words by number of bytes
_EDGE = 0  # stands for the text's edge before its first word
SLICES = 1
_CHUNK = 1 << 20  # bytes of text hashed at a time
_TEXT = 1 << 23  # bytes of text whose bigrams are counted together before they travel
_BUCKET = 3 << 22  # bytes of text whose bigrams are added up together
_SAMPLE = 1 / 64  # share of the documents that tells which words are frequent
_UNIT = 2.0**-24  # losses are summed as whole numbers of it, so that their order does not matter


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``_CHUNK`` bytes, or of one text."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _CHUNK:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if texts:
        yield begin, len(texts)


def hashed_words(texts: list[bytes], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each word. With ``known`` (sorted) any other word is the number of its bytes, up to 15."""
    data = b"\n".join(texts)
    words = word_hashes(data)
    if not len(words):
        return np.zeros(0, np.int64), words
    raw = np.frombuffer(data, np.uint8)
    kept = np.flatnonzero((raw != 0x20) & ((raw < 0x09) | (raw > 0x0D)))
    starts = np.flatnonzero(np.concatenate(([True], kept[1:] != kept[:-1] + 1)))
    if known is not None:
        at = np.minimum(np.searchsorted(known, words), max(len(known) - 1, 0))
        lengths = np.minimum(np.diff(np.concatenate((starts, [len(kept)]))), _CLASSES).astype(np.uint64)
        words = np.where(known[at] == words, words, lengths) if len(known) else lengths
    return np.searchsorted(np.cumsum([len(x) + 1 for x in texts]), kept[starts], side="right"), words


def _words(known):
    """Rows (b, n): a word and how often it occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["data"].to_pylist()
            for begin, end in _chunks(texts):
                _, words = hashed_words(texts[begin:end], known and known.value)
                kinds, n = np.unique(words, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n)], ["b", "n"])
    return run


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in the order of their first occurrence, and the place of each value among them."""
    found = pa.array(values).dictionary_encode()
    return found.dictionary.to_numpy(zero_copy_only=False), found.indices.to_numpy(zero_copy_only=False)


def _summed(at: np.ndarray, numbers: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, numbers, size).astype(np.int64)  # exact below 2**53


def _narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on, each in as few bytes as the largest needs."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0)))).tobytes()


def _wide(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // count}").astype(np.int64) if count else np.zeros(0, np.int64)


class _Chunk:
    """Words and bigrams of a chunk's rows, in an order that depends on the texts alone.

    ``heads`` are the distinct words by bucket; ``first`` and ``second`` the words of the distinct bigrams by
    bucket, in it those after a frequent word (``often``, a place in ``hot``) last. ``pair`` is the bigram of each
    place in the texts, ``sizes`` the words of each row.
    """

    def __init__(self, table: pa.Table, known, hot: np.ndarray, buckets: int):
        order = np.lexsort((table["d2"].to_numpy(), table["d1"].to_numpy()))
        self.rows = table.take(pa.array(order))
        texts = self.rows["data"].to_pylist()
        parts = [(begin, *hashed_words(texts[begin:end], known and known.value)) for begin, end in _chunks(texts)]
        self.text = np.concatenate([np.zeros(0, np.int32), *((text + begin).astype(np.int32) for begin, text, _ in parts)])
        words = np.concatenate([np.zeros(0, np.uint64), *(w for *_, w in parts)])
        del texts, parts
        self.sizes = np.bincount(self.text, minlength=len(order))
        kinds, self.word = _coded(words)
        del words
        edge = len(kinds)
        before = np.concatenate((np.full(min(1, len(self.word)), edge), self.word[:-1])).astype(np.int64)
        before[1:][self.text[1:] != self.text[:-1]] = edge
        keys, pair = _coded(before * (edge + 1) + self.word)
        del before
        first, second = (x.astype(np.int32) for x in np.divmod(keys, edge + 1))
        heads = np.concatenate((kinds, np.array([_EDGE], np.uint64)))
        at = np.minimum(np.searchsorted(hot, heads), len(hot) - 1)
        often = np.where(hot[at] == heads, at, -1)
        with np.errstate(over="ignore"):
            own = (_mix(heads) % np.uint64(buckets)).astype(np.int64)
            spread_out = (_mix(heads[first] * _BASE + heads[second]) % np.uint64(buckets)).astype(np.int64)
        by_bucket = np.argsort(own[:edge], kind="stable")
        rank = np.zeros(edge + 1, np.int32)
        rank[by_bucket] = np.arange(edge)
        bucket = np.where(often[first] >= 0, spread_out, own[first])
        by_pair = np.argsort(
            bucket * (edge + len(hot)) + np.where(often[first] >= 0, edge + often[first], rank[first]), kind="stable")
        place = np.zeros(len(keys), np.int32)
        place[by_pair] = np.arange(len(keys))
        self.heads, self.word, self.pair = kinds[by_bucket], rank[self.word], place[pair]
        self.first, self.second = rank[first[by_pair]], rank[second[by_pair]]
        self.often = often[first[by_pair]]
        self.head_ends = np.searchsorted(own[by_bucket], np.arange(buckets + 1))
        self.pair_ends = np.searchsorted(bucket[by_pair], np.arange(buckets + 1))


_SENT = ["w", "n_b", "target_b", "followers", "often", "b", "n", "target"]


def _send(known, hot: np.ndarray, buckets: int, part: int, parts: int):
    """What a chunk sends to the buckets of slice ``part`` of ``parts``: a row of arrays for each."""
    def run(key, table):
        c = _Chunk(table, known, hot, buckets)
        copies = c.rows["copies"].to_numpy()
        good = np.where(c.rows["target"].to_numpy(zero_copy_only=False).astype(bool), copies, 0)
        size, pairs = len(c.heads), len(c.first)
        n_b, target_b = (_summed(c.word, x[c.text], size) for x in (copies, good))
        n, target = (_summed(c.pair, x[c.text], pairs) for x in (copies, good))
        plain = c.often < 0
        followers = np.bincount(c.first[plain], minlength=size)
        rows = []
        for j in range(part, buckets, parts):
            h, p = (slice(ends[j], ends[j + 1]) for ends in (c.head_ends, c.pair_ends))
            if h.start < h.stop or p.start < p.stop:
                rows.append((j, c.heads[h].tobytes(), _narrow(n_b[h]), _narrow(target_b[h]), _narrow(followers[h]),
                             c.often[p][~plain[p]].astype("<u4").tobytes(), c.heads[c.second[p]].tobytes(),
                             _narrow(n[p]), _narrow(target[p])))
        columns = list(zip(*rows)) or [()] * 9
        return pa.Table.from_arrays(
            [pa.array([key[0].as_py()] * len(rows), pa.int32()), pa.array(columns[0], pa.int32()),
             *(pa.array(x, pa.binary()) for x in columns[1:])], ["chunk", "bucket", *_SENT])
    return run


_TOTALS = ["n_b", "target_b", "n_a", "target_a", "kinds", "target_kinds"]
_REPLY = (
    "chunk int, bucket int, " + ", ".join(f"{c} binary" for c in [*_TOTALS, "n", "target"])
    + ", totals array<struct<often: int, n: bigint, target: bigint, kinds: bigint, target_kinds: bigint>>")


def _add_up(hot: int):
    """Totals of a bucket, returned to each chunk in the order of its arrays.

    One more row, without a chunk, has ``totals`` of what the bucket has of each frequent first word, and at -1
    the sums over its words: how many, and their occurrences in all and in target documents.
    """
    def run(key, table):
        rows = table.to_pylist()
        words = [np.frombuffer(r["w"], np.uint64) for r in rows]
        heads, at = _coded(np.concatenate(words))
        size = len(heads)
        ends = np.cumsum([0, *map(len, words)])
        n_b, target_b = (
            _summed(at, np.concatenate([_wide(r[c], len(w)) for r, w in zip(rows, words)]), size) for c in _TOTALS[:2])
        seconds = [np.frombuffer(r["b"], np.uint64) for r in rows]
        after, begin = [], 0
        for r, w in zip(rows, words):
            after.append(np.repeat(at[begin:begin + len(w)], _wide(r["followers"], len(w))))
            after.append(np.frombuffer(r["often"], "<u4").astype(np.int32) + np.int32(size))
            begin += len(w)
        kinds, second = _coded(np.concatenate(seconds))
        keys, pair = _coded(np.concatenate(after).astype(np.int64) * max(1, len(kinds)) + second)
        n, target = (
            _summed(pair, np.concatenate([_wide(r[c], len(b)) for r, b in zip(rows, seconds)]), len(keys))
            for c in ("n", "target"))
        first = keys // max(1, len(kinds))
        sums = [_summed(first, x, size + hot) for x in (n, target, np.ones(len(keys)), target > 0)]
        columns = [[] for _ in range(8)]
        pair_ends = np.cumsum([0, *map(len, seconds)])
        for i in range(len(rows)):
            own, pairs = at[ends[i]:ends[i + 1]], pair[pair_ends[i]:pair_ends[i + 1]]
            values = [*(x[own] for x in (n_b, target_b, *sums)), n[pairs], target[pairs]]
            for column, x in zip(columns, values):
                column.append(_narrow(x))
        totals = [(-1, size, int(n_b.sum()), int(target_b.sum()), 0)]
        totals += [(int(i), *(int(x[size + i]) for x in sums)) for i in np.flatnonzero(sums[0][size:])]
        names = ["often", "n", "target", "kinds", "target_kinds"]
        kind = pa.list_(pa.struct([("often", pa.int32()), *((c, pa.int64()) for c in names[1:])]))
        return pa.Table.from_arrays(
            [pa.array([*(r["chunk"] for r in rows), None], pa.int32()),
             pa.array([key[0].as_py()] * (len(rows) + 1), pa.int32()),
             *(pa.array([*x, None], pa.binary()) for x in columns),
             pa.array([None] * len(rows) + [[dict(zip(names, x)) for x in totals]], kind)],
            ["chunk", "bucket", *_TOTALS, "n", "target", "totals"])
    return run


def _loss(n, total, kinds, word, words: int, size: int) -> np.ndarray:
    """Loss (negative natural logarithm) of a word after another one, in units."""
    kinds = np.maximum(kinds, 1)
    alone = (word + 1) / float(words + size)
    return np.floor(-np.log((n + kinds * alone) / (total + kinds)) / _UNIT + 0.5).astype(np.int64)


def _sum_losses(known, hot: np.ndarray, often: np.ndarray, buckets: int, words: int, target_words: int, size: int):
    """Losses of a chunk's rows from the buckets' replies; ``often`` are the totals of the words ``hot``."""
    def run(key, table, reply):
        c = _Chunk(table, known, hot, buckets)
        rows = reply.sort_by("bucket").to_pylist()
        counts = [(c.head_ends[r["bucket"] + 1] - c.head_ends[r["bucket"]],
                   c.pair_ends[r["bucket"] + 1] - c.pair_ends[r["bucket"]]) for r in rows]
        column = lambda name, of: np.concatenate(
            [np.zeros(0, np.int64), *(_wide(r[name], n[of]) for r, n in zip(rows, counts))])
        n_b, target_b, *after = (column(x, 0) for x in _TOTALS)
        n_a, target_a, kinds, target_kinds = (
            np.where(c.often >= 0, many[c.often], x[np.minimum(c.first, len(x) - 1)] if len(x) else 0)
            for x, many in zip(after, often))
        losses = [
            _loss(column("target", 1), target_a, target_kinds, target_b[c.second], target_words, size),
            _loss(column("n", 1), n_a, kinds, n_b[c.second], words, size)]
        ends = np.cumsum(c.sizes)
        target_loss, loss = (
            np.diff(np.concatenate(([0], np.cumsum(x[c.pair])))[np.concatenate(([0], ends))]) * _UNIT / np.maximum(c.sizes, 1)
            for x in losses)
        again = np.repeat(np.arange(len(ends)), c.rows["copies"].to_numpy())
        return pa.Table.from_arrays(
            [c.rows["doc_id"].take(pa.array(again)).combine_chunks(),
             *(pa.array(x[again]) for x in (c.sizes, target_loss, loss, target_loss - loss))],
            ["doc_id", "n_words", "target_loss", "background_loss", "score"])
    return run


def score(docs: DataFrame, targets: DataFrame, words: int | None = None, slices: int = SLICES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, target_loss, background_loss, score (their difference).

    ``targets`` holds the doc_ids of target documents; a low score is close to them. Words are split at
    ASCII white space and A-Z lowered. Losses are natural logarithms per word, the first word following the
    text's edge; a null or wordless text has 0 words and score 0. Repeated ids in ``targets`` count once;
    null ids match nothing. With no target document the target model is uniform. Equal rows count each.
    Other columns are not read; an empty table gives an empty result.

    All words are known. On request only the ``words`` most frequent are, of equal ones those of the lower
    hash, and the others are classes by length; the hashes of the known ones are then sent to all tasks. Words
    are compared by 64-bit hashes. ``slices`` changes no result: with more of them the buckets are filled
    one part after the other, which takes less disk and more time.
    """
    spark = docs.sparkSession
    wanted = targets.select(F.col("doc_id").alias("_target")).where("_target IS NOT NULL").distinct()
    texts = docs.select("doc_id", F.coalesce(F.encode("text", "UTF-8"), F.lit(b"")).alias("data"))
    size_of = texts.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    chunks, buckets = (max(1, math.ceil(size_of / x)) for x in (_TEXT, _BUCKET))

    def word_counts(known, rows):
        return rows.select("data").mapInArrow(_words(known), "b long, n long").groupBy("b").agg(F.sum("n").alias("n_b"))

    known = None
    if words is not None:
        common = word_counts(None, texts).orderBy(F.desc("n_b"), "b").limit(words).select("b").toArrow()
        known = spark.sparkContext.broadcast(np.sort(common["b"].to_numpy().astype(np.int64).view(np.uint64)))
    often = []
    if buckets > 1:
        sampled = stored(word_counts(known, texts.sample(_SAMPLE, 0)))
        many = F.col("n_b") > sampled.agg(F.coalesce(F.sum("n_b"), F.lit(0))).first()[0] / (4 * buckets)
        often = [r[0] for r in sampled.where(many).select("b").collect()]  # fewer than 4 for each bucket
        drop(sampled)
    hot = np.unique(np.append(np.array(often, np.int64).view(np.uint64), np.uint64(_EDGE)))

    def chunked(rows, *more):
        # The same row goes to the same chunk each time; copies of a text under other ids to any. Equal rows are one.
        digest = [F.xxhash64("data").alias("d1"), F.xxhash64(F.lit(1), "data").alias("d2")]
        chunk = F.pmod(F.xxhash64("doc_id", "data"), F.lit(chunks)).cast("int").alias("chunk")
        return rows.select(chunk, "doc_id", *digest, "data", *more).repartition("chunk").groupBy(
            "chunk", "doc_id", "d1", "d2").agg(
                F.first("data").alias("data"), F.count(F.lit(1)).alias("copies"), *(F.first(c).alias(c) for c in more))

    flagged = lookup_join(texts, wanted, F.col("doc_id") == F.col("_target"), "left").select(
        "doc_id", "data", F.col("_target").isNotNull().alias("target"))
    sent = "chunk int, bucket int, " + ", ".join(f"{c} binary" for c in _SENT)
    replies = [
        stored(chunked(flagged, "target").groupBy("chunk").applyInArrow(_send(known, hot, buckets, part, slices), sent)
               .groupBy("bucket").applyInArrow(_add_up(len(hot)), _REPLY))
        for part in range(slices)]
    reply = reduce(DataFrame.unionAll, replies)
    totals = {
        r[0]: r[1:] for r in reply.where("chunk IS NULL").select(F.explode("totals").alias("t")).select("t.*")
        .groupBy("often").agg(*(F.sum(c) for c in ("n", "target", "kinds", "target_kinds"))).collect()}
    distinct, total, target_total, _ = totals.get(-1, (0, 0, 0, 0))
    of_hot = np.array([totals.get(i, (0, 0, 0, 0)) for i in range(len(hot))], np.int64).T
    size = (distinct if known is None else len(known.value)) + _CLASSES + 1
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return chunked(texts).groupBy("chunk").cogroup(reply.where("chunk IS NOT NULL").drop("totals").groupBy("chunk")).applyInArrow(
        _sum_losses(known, hot, of_hot, buckets, total, target_total, size),
        f"doc_id {doc_id}, n_words long, target_loss double, background_loss double, score double")
