"""Mix sources to target weights by Poisson replication.

A source's repetition rate is its target share of the output over its size. Each document draws its
number of copies by inverting the Poisson distribution of that mean at a uniform number hashed from
the seed and the document, so a draw depends on nothing else and every retry gives the same rows. The
copies are then dealt to partitions and ordered by another hash: a shuffle of the whole output.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import column, stored
from martlet.sizing import lookup_join


def poisson_steps(mean: float) -> np.ndarray:
    """Distribution function of a Poisson variable at 0, 1, ... until it is 1 to the last digit."""
    if mean <= 0:
        return np.ones(1)
    n = int(mean + 12 * math.sqrt(mean) + 40)
    k = np.arange(n + 1)
    log_factorial = np.concatenate(([0.0], np.cumsum(np.log(k[1:]))))
    return np.minimum(np.cumsum(np.exp(k * math.log(mean) - mean - log_factorial)), 1.0)


def _with_steps(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield frame.assign(steps=[poisson_steps(m).tolist() for m in frame["rate"]])


def uniform(seed: int, what: str, *columns: str) -> Column:
    """A number in (0, 1) from 52 bits of a hash of the seed, a purpose and the columns."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(f"{seed}:{what}"), *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def rates(
    docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, power: float = 0.5,
) -> DataFrame:
    """(source, docs, bytes, rate, steps) for each source, null included.

    ``weights`` are target shares of the output's bytes by source; a source without one is left out. By
    default a source's weight is its bytes to ``power``. ``epochs`` is the output's size over the input's.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    sizes = stored(docs.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum(size).alias("bytes")))
    if weights is None:
        weight = F.pow(F.col("bytes").cast("double"), F.lit(power))
    else:
        if any(w < 0 for w in weights.values()) or sum(weights.values()) <= 0:
            raise ValueError("weights are not negative and not all zero")
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source") == name, F.lit(float(value))).otherwise(weight)
    sizes = sizes.withColumn("weight", weight)
    weighed = sizes.where("bytes > 0")
    all_weight, all_bytes = (weighed.agg(F.sum(c)).scalar() for c in ("weight", "bytes"))
    rate = F.when(F.col("bytes") > 0, F.coalesce(
        F.lit(float(epochs)) * all_bytes * F.col("weight") / (all_weight * F.col("bytes")),
        F.lit(0.0))).otherwise(F.lit(float(epochs)))
    return stored(
        sizes.select("source", "docs", "bytes", rate.alias("rate"))
        .mapInPandas(_with_steps, "source string, docs long, bytes long, rate double, steps array<double>"))


def mix(
    docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, power: float = 0.5, seed: int = 0,
) -> DataFrame:
    """Rows of ``docs`` as often as drawn, all columns kept, with copy (from 1), copies and rate, shuffled.

    A null source is a source of its own. A source of empty texts has no bytes to weigh: its rate is
    ``epochs``. Documents that draw 0 are not in the output. Rows equal in doc_id and text draw alike.
    Columns named like the added ones are replaced. An empty table gives an empty result.
    """
    table = rates(docs, weights, epochs, power).select(F.col("source").alias("of"), "rate", "steps")
    kept = [c for c in docs.columns if c not in ("copy", "copies", "rate")]
    # Plain names while the helper columns are beside them, so that any name is allowed outside.
    plain = [f"c{i}" for i in range(len(kept))]
    source, doc_id, text = (plain[kept.index(c)] for c in ("source", "doc_id", "text"))
    rows = docs.select(*[column(c) for c in kept]).toDF(*plain)
    drawn = (
        lookup_join(rows, table, F.col(source).eqNullSafe(F.col("of")))
        .withColumn("u", uniform(seed, "count", doc_id, text))
        .withColumn("copies", F.size(F.filter("steps", lambda p: p < F.col("u")))))
    copies = (
        drawn.where("copies > 0")
        .select(*plain, F.explode(F.sequence(F.lit(1), "copies")).alias("copy"), "copies", "rate")
        .withColumn("place", F.xxhash64(F.lit(seed), doc_id, text, "copy")))
    dealt = copies.repartition("place").sortWithinPartitions("place").drop("place")
    return dealt.toDF(*kept, "copy", "copies", "rate")


ORACLE = """
WITH sizes AS (
  SELECT source, sum(coalesce(octet_length(encode(text)), 0)) AS bytes FROM documents GROUP BY source
), total AS (
  SELECT sum(sqrt(bytes)) AS all_weight, sum(bytes) AS all_bytes FROM sizes WHERE bytes > 0
), rates AS (
  SELECT source, CASE WHEN bytes > 0 THEN 1.0::DOUBLE * all_bytes * sqrt(bytes) / (all_weight * bytes) ELSE 1.0 END AS rate
  FROM sizes, total
), steps AS (
  SELECT source, rate, list(p ORDER BY k) AS steps FROM (
    SELECT source, rate, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p
    FROM (SELECT source, rate, unnest(range(0, cast(floor(rate + 12 * sqrt(rate) + 41) AS BIGINT))) AS k FROM rates))
  GROUP BY source, rate
), drawn AS (
  SELECT d.doc_id, d.source, d.text,
    len(list_filter(s.steps, lambda p: p < (
      cast('0x' || substr(md5('0:count|' || coalesce(cast(d.doc_id AS VARCHAR), chr(0)) || '|' || coalesce(d.text, chr(0))), 1, 13)
        AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0)) AS copies
  FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, source, cast(unnest(range(1, copies + 1)) AS INTEGER) AS copy, cast(copies AS INTEGER) AS copies,
  md5(text) AS text_md5
FROM drawn WHERE copies > 0
"""
