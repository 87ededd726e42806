"""A training corpus from documents: stages that each call one operator of martlet.llm.

Every stage takes an empty table to an empty table and keeps further columns, whatever their names, but for the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm import language_mix, ngram_join, packing, poisson_mix, surrogates
from martlet.llm.common import column, drop, stored

#: Key of the surrogates; a user sets one of their own.
KEY = b"corpus pipeline"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in learned languages, one or several; those without letters go, as do noise and unknown scripts."""
    return language_mix.accepted(language_mix.identify(docs)).select(*map(column, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class linked by 5-word shingles at a similarity of 0.8; the smallest doc_id.

    Of repeated rows one stays; documents without words are no copies of each other.
    """
    return ngram_join.distinct_documents(docs, words=5, num=80, den=100)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; n_chars follows the text. A null text stays null."""
    changed = surrogates.pseudonymise(docs, KEY)
    columns = [F.length("text").cast("long").alias(c) if c == "n_chars" else column(c) for c in docs.columns]
    return changed.select(*columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as drawn for shares by the root of a source's bytes, shuffled; a null source is one."""
    return poisson_mix.mix(docs, epochs=1.0, power=0.5, seed=0).select(*map(column, docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their ids, in windows of 2048 tokens; a null text is its end token."""
    return packing.pack(docs, added=True)


STAGES = [
    ("language", language), ("near_duplicates", near_duplicates), ("private_data", private_data), ("mixing", mixing),
    ("packing", packed),
]

#: Trained models, surrogates and token ids have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order on documents; each one's rows are written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    written = None
    for name, stage in STAGES[:-1]:
        after = stored(stage(spark, docs, sf_dir))
        if written is not None:
            drop(written)
        docs = written = after
    return STAGES[-1][1](spark, docs, sf_dir)
