"""Search over a text column: keyword index with BM25, vector similarity, and their fusion.

The index is a table of postings ``(key, attributes, term, tf, length)`` written batch by batch and
clustered by term, beside one row of statistics per batch. Document counts change with every batch,
so weights are computed when a query runs, from sums over the batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.files import delete
from martlet.operators.ordered import asc, desc, running
from martlet.operators.text import count_terms, tokens
from martlet.sizing import spread, stored

# Fixed values of the published formulas.
K1, B = 1.2, 0.75
FUSION_K = 60
DIGITS = 6


def postings(docs: DataFrame, key: str, text: str, attributes: Sequence[str] = ()) -> DataFrame:
    """``key``, attributes, ``length``, ``term``, ``tf``: one row per distinct term of a document."""
    words = docs.select(key, *attributes, tokens(F.col(text)).alias("_tokens"))
    sized = words.select(key, *attributes, F.size("_tokens").alias("length"), "_tokens")
    return count_terms(sized, [key, *attributes, "length"], key)


def statistics(docs: DataFrame, text: str) -> DataFrame:
    """One row: number of documents and of tokens."""
    return docs.select(F.size(tokens(F.col(text))).alias("n")).agg(
        F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"))


@contextmanager
def written_first(rows: DataFrame, path: str) -> Iterator[DataFrame]:
    """``rows`` from a folder beside the index: a range partitioning reads its input twice, and would tokenise it twice."""
    aside = f"{path}/aside-{uuid.uuid4().hex}"
    rows.write.parquet(aside)
    yield rows.sparkSession.read.schema(rows.schema).parquet(aside)
    delete(rows.sparkSession, aside)


class SearchIndex:
    """A stored index under ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str, attributes: Sequence[str] = ()):
        self.spark, self.path, self.key, self.attributes = spark, path, key, tuple(attributes)

    def add(self, docs: DataFrame, text: str, batch_id: int) -> None:
        """Index new documents only. Adding a batch again replaces it."""
        docs = spread(docs)
        with written_first(postings(docs, self.key, text, self.attributes), self.path) as new:
            # Sorting by term lets the reader skip the row groups of other terms; the key splits a
            # term that occurs in most documents over several files.
            new.repartitionByRange("term", self.key).sortWithinPartitions("term", self.key).write.mode(
                "overwrite").parquet(f"{self.path}/postings/batch={batch_id}")
        statistics(docs, text).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/statistics/batch={batch_id}")

    @property
    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/postings").drop("batch")

    @property
    def statistics(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/statistics")

    def terms(self, query: str) -> list[str]:
        """The distinct terms of a query, tokenised like the documents."""
        row = self.spark.range(1).select(F.array_distinct(tokens(F.lit(query))).alias("t")).first()
        return row["t"]

    def keyword_scores(self, query: str, equal: dict | None = None) -> DataFrame:
        """``key``, ``score`` of every document that has a term of the query."""
        return bm25(self.postings, self.statistics, self.terms(query), self.key, equal)


def bm25(
    postings: DataFrame, statistics: DataFrame, terms: list[str], key: str, equal: dict | None = None
) -> DataFrame:
    """BM25 over postings; ``equal`` keeps only documents with these attribute values.

    Term weights always come from the whole collection. There is at most one weight per query term,
    so the weights may be broadcast.
    """
    hits = postings.where(F.col("term").isin(terms))
    totals = statistics.agg(F.sum("documents").alias("n"), F.sum("tokens").alias("t"))
    n = totals.select(F.col("n").cast("double")).scalar()
    average = totals.select(F.col("t") / F.col("n").cast("double")).scalar()
    weights = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        "term", F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    for column, value in (equal or {}).items():
        hits = hits.where(F.col(column) == F.lit(value))
    tf, length = F.col("tf"), F.col("length")
    part = F.col("idf") * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average))
    return hits.join(F.broadcast(weights), "term").groupBy(key).agg(
        F.round(F.sum(part), DIGITS).alias("score"))


def cosine(vector: Column, query: Sequence[float]) -> Column:
    """Cosine similarity with a fixed vector, rounded."""
    fixed = F.array(*[F.lit(float(x)) for x in query])
    exact = vector.cast("array<double>")

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    dot = total(F.zip_with(exact, fixed, lambda a, b: a * b))
    length = F.sqrt(total(F.transform(exact, lambda x: x * x)))
    norm = sum(float(x) ** 2 for x in query) ** 0.5
    return F.round(dot / F.nullif(length * norm, F.lit(0.0)), DIGITS)


def vector_scores(vectors: DataFrame, key: str, vector: str, query: Sequence[float],
                  equal: dict | None = None) -> DataFrame:
    for column, value in (equal or {}).items():
        vectors = vectors.where(F.col(column) == F.lit(value))
    # A filter on the score itself would be pushed below it and compute it twice.
    directed = F.exists(vector, lambda x: x != 0) & ~F.exists(vector, lambda x: x.isNull())
    return vectors.where(directed).select(key, cosine(F.col(vector), query).alias("score"))


def top(scores: DataFrame, key: str, limit: int) -> DataFrame:
    return scores.orderBy(F.desc("score"), key).limit(limit)


def fuse(by_keyword: DataFrame, by_vector: DataFrame, key: str) -> DataFrame:
    """Reciprocal-rank fusion of two score tables: ``key``, ``score``.

    Every scored document is ranked in both lists, not only the first few of each, so the fused
    order is exact.
    """
    def ranks(scores: DataFrame, name: str) -> DataFrame:
        # Stored: numbering a large list reads it several times.
        return running(stored(scores), [], [*desc("score"), *asc(key)], number=name).select(key, name)

    both = ranks(by_keyword, "_k").join(ranks(by_vector, "_v"), key, "full")
    share = [F.coalesce(1 / (FUSION_K + F.col(c)), F.lit(0.0)) for c in ("_k", "_v")]
    return both.select(key, F.round(share[0] + share[1], DIGITS).alias("score"))


def with_columns(found: DataFrame, docs: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Columns of the found documents. ``found`` has at most a search limit of (key, score) rows, so
    it may be broadcast without counting it, which would run the search twice."""
    return docs.select(key, *[c for c in columns if c != key]).join(F.broadcast(found), key)


def as_response(found: DataFrame, columns: Sequence[str], limit: int) -> DataFrame:
    """One variant object ``{"results": [...]}`` in score order, of at most ``limit`` results."""
    rows = F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("_order"), F.struct(*columns).alias("row"))))
    return found.limit(limit).agg(F.to_variant_object(
        F.struct(F.transform(rows, lambda r: r["row"]).alias("results"))).alias("raw"))


def equality_filter(condition: dict | None) -> dict:
    """``{"@eq": {column: value}}`` to column values; nothing else is supported."""
    if not condition:
        return {}
    if set(condition) != {"@eq"}:
        raise ValueError("only @eq filters are supported")
    return dict(condition["@eq"])


def search(
    index: SearchIndex, vectors: DataFrame, vector: str, docs: DataFrame,
    query: str, query_vector: Sequence[float], columns: Sequence[str], limit: int,
    condition: dict | None = None,
) -> DataFrame:
    """Hybrid search: the ``limit`` best documents with ``columns`` and their fused score."""
    equal = equality_filter(condition)
    fused = fuse(
        index.keyword_scores(query, equal),
        vector_scores(vectors, index.key, vector, query_vector, equal), index.key)
    return with_columns(top(fused, index.key, limit), docs, index.key, columns)
