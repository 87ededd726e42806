"""Reciprocal-rank fusion of two score lists by reading both in growing depth.

A document that neither list has shown down to depth d scores at most the sum of two shares at rank d + 1. Depth grows
until that is below the k-th score found so far. A document seen in one list only is then bounded by the other
list's next share; of those that can still be among the first k, the exact rank in the other list is counted, all in
one pass. So no list is sorted or numbered whole: each depth is a partial top list in every task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.operators.search import DIGITS, FUSION_K

_ROOM = 10.0**-DIGITS  # fused scores are rounded before they are compared
COUNTED = 200  # ranks that one pass counts at most; more are left to a greater depth


@dataclass
class Fused:
    """``scores`` of the first documents, the depth read, and how many ranks were counted."""

    scores: DataFrame
    depth: int
    counted: int


def _share(rank: int | None) -> float:
    return 0.0 if rank is None else 1 / (FUSION_K + rank)


def _head(scores: DataFrame, key: str, depth: int) -> dict:
    found = scores.orderBy(F.desc_nulls_last("score"), F.asc_nulls_first(key)).limit(depth).select(key).collect()
    return {r[0]: i for i, r in enumerate(found, 1)}


def _ranks(scores: DataFrame, key: str, wanted: list) -> dict:
    """Rank of each wanted document that the list holds."""
    own = scores.where(F.col(key).isin(wanted)).select(key, "score").collect()
    before = [
        F.count_if((F.col("score") > r["score"]) | ((F.col("score") == r["score"]) & (F.col(key) < F.lit(r[0])))).alias(f"c{i}")
        for i, r in enumerate(own)]
    counts = scores.agg(*before).first() if before else []
    return {r[0]: counts[i] + 1 for i, r in enumerate(own)}


def fused_top(by_keyword: DataFrame, by_vector: DataFrame, key: str, k: int, depth: int | None = None) -> Fused:
    """The first ``k`` of ``search.fuse``: (key, score) by score, ties by key. Scores are not NULL, keys unique and not NULL."""
    lists, depth = (by_keyword, by_vector), depth or 32 * k
    schema = by_keyword.select(key, F.lit(0.0).alias("score")).schema
    while True:
        heads = [_head(scores, key, depth) for scores in lists]
        beyond = [0.0 if len(h) < depth else _share(depth + 1) for h in heads]  # 0 where the list has ended
        seen = set(heads[0]) | set(heads[1])
        lower = {d: sum(_share(h.get(d)) for h in heads) for d in seen}
        upper = {d: sum(_share(h[d]) if d in h else b for h, b in zip(heads, beyond)) for d in seen}
        least = sorted(lower.values(), reverse=True)[k - 1] if len(lower) >= k else 0.0
        ended = not any(beyond)
        if ended or sum(beyond) + _ROOM < least:
            possible = [d for d in seen if upper[d] + _ROOM >= least]
            open_ = [[d for d in possible if b and d not in h] for h, b in zip(heads, beyond)]
            if max(map(len, open_)) <= COUNTED:
                break
        depth *= 4
    for scores, head, wanted in zip(lists, heads, open_):
        if wanted:
            head.update(_ranks(scores, key, wanted))
    final = sorted((-round(sum(_share(h.get(d)) for h in heads), DIGITS), d) for d in possible)[:k]
    found = by_keyword.sparkSession.createDataFrame([(d, -s) for s, d in final], schema)  # k rows
    return Fused(found, depth, sum(map(len, open_)))
