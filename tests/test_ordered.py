"""Ordered operators: cut into many segments they must equal the plain window, hot keys included."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from martlet.operators.ordered import Key, asc, cut, desc, framed, latest_per_key, ranked, running


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, many share one value, some keys and values are null."""
    n = F.col("id")
    df = spark.range(3000).select(
        n.alias("id"),
        F.when(n % 3 == 0, "hot").when(n % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), (n % 40).cast("string"))).alias("key"),
        F.when(n % 2 == 0, 7).when(n % 97 == 1, None).otherwise(F.pmod(n * 7919, F.lit(53)))
        .cast("int").alias("value"),
    ).repartition(4)
    return df.persist()


SMALL = 100  # rows per segment


def test_cut_is_monotone_and_balanced(skewed):
    segmented = cut(skewed, ["key"], asc("value", "id"), SMALL)
    per = segmented.groupBy("_segment").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "value", "id")).alias("low"),
        F.max(F.struct("key", "value", "id")).alias("high")).orderBy("_segment").collect()
    assert len(per) > 15 and sum(r.n for r in per) == 3000
    assert max(r.n for r in per) < 4 * SMALL
    hot = segmented.where("key = 'hot'").select("_segment").distinct().count()
    assert hot > 5
    order = segmented.select("_segment", F.struct("key", "value", "id").alias("p"))
    before = order.groupBy("_segment").agg(F.min("p").alias("a"), F.max("p").alias("b"))
    w = W.orderBy("_segment")
    assert before.withColumn("prev", F.lag("b").over(w)).where("prev >= a").count() == 0


@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("order", [asc("value", "id"), [*desc("value"), *asc("id")]])
def test_running_equals_window(skewed, keys, order):
    spec = (W.partitionBy(*keys) if keys else W).orderBy(*[k.sort for k in order])
    expected = skewed.withColumn("n", F.row_number().over(spec)).withColumn(
        "s", F.sum("value").over(spec.rowsBetween(W.unboundedPreceding, 0)))
    found = running(skewed, keys, order, {"s": F.col("value")}, "n", rows_per_segment=SMALL)
    assert rows(found.select("id", "n", "s")) == rows(expected.select("id", "n", "s"))
    assert found.schema["n"].dataType == T.LongType()  # a key may have more rows than an int counts
    assert found.schema["s"].dataType == expected.schema["s"].dataType


@pytest.mark.parametrize("by", [Key("value"), Key("value", True)])
@pytest.mark.parametrize("keys", [["key"], []])
def test_ranks_equal_window(skewed, by, keys):
    spec = (W.partitionBy(*keys) if keys else W).orderBy(by.sort)
    expected = skewed.withColumn("r", F.rank().over(spec)).withColumn("d", F.dense_rank().over(spec))
    found = ranked(skewed, keys, by, asc("id"), "r", "d", rows_per_segment=SMALL)
    assert rows(found.select("id", "r", "d")) == rows(expected.select("id", "r", "d"))


@pytest.mark.parametrize("back,ahead", [(1, 1), (5, 0), (0, 3)])
def test_frames_equal_window(skewed, back, ahead):
    order = asc("value", "id")

    def columns(w):
        return {
            "total": F.sum("value").over(w.rowsBetween(-back, ahead)),
            "prev": F.lag("id", back, -1).over(w) if back else F.lit(0),
            "next": F.lead("id", ahead).over(w) if ahead else F.lit(0),
        }

    expected = skewed.withColumns(columns(W.partitionBy("key").orderBy(*[k.sort for k in order])))
    found = framed(skewed, ["key"], order, back, ahead, columns, rows_per_segment=SMALL)
    names = ["id", "total", "prev", "next"]
    assert rows(found.select(*names)) == rows(expected.select(*names))


def test_latest_per_key(spark, skewed):
    found = latest_per_key(skewed, ["key"], ["value", "id"])
    spec = W.partitionBy("key").orderBy(F.desc_nulls_last("value"), F.desc("id"))
    expected = skewed.withColumn("n", F.row_number().over(spec)).where("n = 1").drop("n")
    assert rows(found) == rows(expected)


def test_frame_longer_than_a_segment(skewed):
    def around(spec):
        return {"m": F.sum("value").over(spec.rowsBetween(-150, 70))}

    found = framed(skewed, ["key"], asc("value", "id"), 150, 70, around, rows_per_segment=50)
    expected = skewed.withColumns(around(W.partitionBy("key").orderBy("value", "id")))
    assert rows(found.select("id", "m")) == rows(expected.select("id", "m"))
