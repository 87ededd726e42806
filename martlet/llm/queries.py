"""The named queries of this package and the SQL that some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm import (
    ball_tree, bpe_stream, centroid_search, cross_entropy, language_mix, learned_partitions, ngram_join, norm_search,
    packing, poisson_mix, ring_shards, suffix_dedup, surrogates,
)

#: Classes of documents as a join on shingles and the closure of its links; for small tables.
NGRAM_CLASSES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)
), reached AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, least(d.doc_id, min(r.b)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reached r ON r.a = d.doc_id
GROUP BY d.doc_id
"""

ORACLE: dict[str, str] = {
    "op3_ngram_jaccard": NGRAM_CLASSES, "op5_poisson_mix": poisson_mix.ORACLE, "op9_norm_buckets": norm_search.ORACLE,
    "op11_centroid_search": centroid_search.oracle(),
    "op12_ball_tree": ball_tree.ORACLE,
}

#: Key of the surrogates in the registered query; a user passes one of their own.
KEY = b"registered query"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of all documents without any 200-byte string that starts twice."""
    return suffix_dedup.digest(suffix_dedup.remove_repeats(_table(spark, folder, "documents")))


def op2_learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """10 nearest of every hundredth vector, in those learned partitions that hold their likely neighbours."""
    return learned_partitions.nearest(_table(spark, folder, "embeddings"), k=10, every=100)


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of documents linked by 4-word shingles at a Jaccard similarity of 0.85."""
    classes = ngram_join.similar_classes(_table(spark, folder, "documents"), words=4, num=85, den=100)
    return classes.select("doc_id", "n_shingles", "component_id")


def op4_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with keyed surrogates for personal data."""
    changed = surrogates.pseudonymise(_table(spark, folder, "documents"), key=KEY)
    return changed.select(
        "doc_id", F.size("entities").cast("long").alias("n_entities"),
        F.transform("entities", lambda e: e["kind"]).alias("kinds"), "text")


def op5_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    """All documents at rates that give each source a share by the root of its bytes, shuffled."""
    mixed = poisson_mix.mix(_table(spark, folder, "documents"), epochs=1.0, power=0.5, seed=0)
    return mixed.select("doc_id", "source", "copy", "copies", F.md5("text").alias("text_md5"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens with the sources' own shares."""
    return packing.digest(packing.pack(_table(spark, folder, "documents"), added=True))


def op7_cross_entropy(spark: SparkSession, folder: str) -> DataFrame:
    """Loss of all documents by a model of those labelled good, less that by a model of all."""
    good = _table(spark, folder, "labels").where("quality = 1")
    return cross_entropy.score(_table(spark, folder, "documents"), good)


def op8_ring_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents on a ring of 40 shards with equal room."""
    placed = ring_shards.assign(_table(spark, folder, "documents"), shards=40)
    return placed.select("*", F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


def op9_norm_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """10 largest whole-number products of every hundredth vector, exactly."""
    return norm_search.top_products(_table(spark, folder, "embeddings"), k=10, every=100, scale=1024.0)


def op10_language_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of all documents, learned from those that are not held out."""
    found = language_mix.identify(_table(spark, folder, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.to_json("shares").alias("shares"))


def op11_centroid_search(spark: SparkSession, folder: str) -> DataFrame:
    """8 clusters of all vectors after 10 rounds, in whole numbers."""
    return centroid_search.cluster(_table(spark, folder, "embeddings"), k=8, rounds=10, width=64, seed=3)


def op12_ball_tree(spark: SparkSession, folder: str) -> DataFrame:
    """10 documents with the highest scores for each benchmark item, exactly."""
    return ball_tree.top_documents(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), k=10)


def op13_bpe_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents by a streaming transducer, and the text that they decode to."""
    encoded = bpe_stream.encode(_table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "ids")
    numbers = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return bpe_stream.decode(encoded).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_learned_partitions": op2_learned_partitions,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_surrogates": op4_surrogates,
    "op5_poisson_mix": op5_poisson_mix,
    "op6_packing": op6_packing,
    "op7_cross_entropy": op7_cross_entropy,
    "op8_ring_shards": op8_ring_shards,
    "op9_norm_buckets": op9_norm_buckets,
    "op10_language_mix": op10_language_mix,
    "op11_centroid_search": op11_centroid_search,
    "op12_ball_tree": op12_ball_tree,
    "op13_bpe_stream": op13_bpe_stream,
}
