"""Top-k keyword search that skips blocks of documents which cannot reach the k-th score.

Documents are dealt into blocks by a hash of their key. Beside the postings stands, for each term and block, how many
of its documents hold the term, the highest frequency and the smallest length among them. The score of a term never
exceeds that of this frequency at this length, whatever the collection's average length is, so a block's sum over the
query's terms bounds all its documents. The blocks with the highest bounds are scored first; their k-th score is a lower
limit, and of the others only blocks whose bound reaches it are read. Postings are sorted by term and block, so a reader
skips the row groups of the other blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.search import B, DIGITS, K1, postings, statistics, written_first
from martlet.operators.text import tokens
from martlet.sizing import limit, lookup_join, spread, stored

BLOCK_DOCUMENTS = 128
_ROOM = 2 * 10.0**-DIGITS  # scores are rounded, their sums are added in any order


def impact(tf: Column, length: Column, average: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average))


@dataclass
class Found:
    """``scores`` of the best documents, and how many blocks hold a term of the query and were read."""

    scores: DataFrame
    blocks: int
    read: int


class BlockIndex:
    """A stored index under ``path``, built once from documents with unique keys."""

    def __init__(self, spark: SparkSession, path: str, key: str, attributes: Sequence[str] = ()):
        self.spark, self.path, self.key, self.attributes = spark, path.rstrip("/"), key, tuple(attributes)

    def build(self, docs: DataFrame, text: str, block_documents: int = BLOCK_DOCUMENTS) -> None:
        docs = spread(docs)
        totals = stored(statistics(docs, text))
        blocks = max(1, -(-totals.first()["documents"] // block_documents))
        block = F.pmod(F.xxhash64(F.col(self.key)), F.lit(blocks)).cast("int").alias("block")
        whole = postings(docs, self.key, text, self.attributes).select("*", block)
        order = ["term", "block", self.key]
        with written_first(whole, self.path) as rows:
            rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option(
                "parquet.block.size", 8 << 20).parquet(f"{self.path}/postings")
        kept = self.spark.read.schema(whole.schema).parquet(f"{self.path}/postings")
        kept.groupBy("term", "block").agg(
            F.count(F.lit(1)).alias("documents"), F.max("tf").alias("tf"), F.min("length").alias("length"),
        ).repartitionByRange("term", "block").sortWithinPartitions("term", "block").write.mode("overwrite").parquet(f"{self.path}/blocks")
        totals.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/statistics")

    def _read(self, part: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{part}")

    def _terms(self, query: str) -> list[str]:
        row = self.spark.range(1).select(F.array_distinct(tokens(F.lit(query))).alias("t")).first()
        return row["t"]

    def top(self, query: str, k: int, equal: dict | None = None) -> Found:
        """The ``k`` documents with the highest scores of those that have the ``equal`` attributes; ties by key.

        Weights always come from the whole collection.
        """
        terms = self._terms(query)
        totals = self._read("statistics").first()
        schema = self._read("postings").select(self.key, F.lit(0.0).alias("score")).limit(0)
        if not terms or not totals["documents"]:
            return Found(schema, 0, 0)
        average = F.lit(totals["tokens"] / totals["documents"])
        tops = self._read("blocks").where(F.col("term").isin(terms))
        n, df = F.lit(float(totals["documents"])), F.col("df")
        weights = tops.groupBy("term").agg(F.sum("documents").alias("df")).select(
            "term", F.log(1 + (n - df + 0.5) / (df + 0.5)).alias("idf"))  # a row for each term of the query
        bounds = stored(
            tops.join(F.broadcast(weights), "term").groupBy("block")
            .agg(F.sum(F.col("idf") * impact(F.col("tf"), F.col("length"), average)).alias("bound")))
        hits = self._read("postings").where(F.col("term").isin(terms))
        for column, value in (equal or {}).items():
            hits = hits.where(F.col(column) == F.lit(value))

        def scored(blocks: DataFrame) -> DataFrame:
            few = [r[0] for r in blocks.select("block").limit(limit(self.spark, "lookupKeys") + 1).collect()]
            own = hits
            if len(few) <= limit(self.spark, "lookupKeys"):
                own = hits.where(F.col("block").isin(few))  # reaches the row groups' statistics
            part = F.col("idf") * impact(F.col("tf"), F.col("length"), average)
            return lookup_join(own, blocks.select("block"), "block", "left_semi").join(
                F.broadcast(weights), "term").groupBy(self.key).agg(F.round(F.sum(part), DIGITS).alias("score"))

        best = lambda rows: rows.orderBy(F.desc("score"), self.key).limit(k)
        first = stored(bounds.orderBy(F.desc("bound"), "block").limit(k))
        begun = stored(best(scored(first)))
        least = begun.agg(F.min("score"), F.count(F.lit(1))).first()
        least = least[0] if least[1] == k else 0.0
        others = bounds.where(F.col("bound") >= least - _ROOM).join(F.broadcast(first.select("block")), "block", "left_anti")
        others = stored(others)
        count, more = bounds.count(), others.count()
        return Found(best(begun.unionByName(scored(others))) if more else begun, count, first.count() + more)
