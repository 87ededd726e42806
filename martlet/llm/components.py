"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import drop, stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links``(a, b), where root is the smallest node it reaches.

    Alternating stars: every node hands its larger neighbours, then its smaller ones, to the smallest.
    Each round is an aggregate with partial minima and a join back, so a node with millions of links
    is a hot join key and never a group in one task. The number of rounds grows with the logarithm of
    the longest chain.
    """
    edges = stored(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct())
        drop(least)
        # Now every node's neighbours here are smaller than it.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
        small = stored(small.where("u <> v").distinct())
        drop(edges, large)
        edges = small
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
