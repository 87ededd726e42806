"""Governance, layout, metric model, quality checks, joins, functions."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from martlet.functions import udfs
from martlet.functions.scalar import safe_divide, tier
from martlet.operators import governance, joins, layout, ml, quality
from martlet.plans.metrics import Dimension, MetricModel, Relationship
from martlet.sizing import with_totals


@pytest.fixture(scope="module")
def fact(spark):
    data = [("e1", "u1", "A1", 2, 10), ("e1", "u1", "B1", 1, 5), ("e2", "u2", "A1", 1, 10),
            ("e3", "u9", "B1", 4, 20), ("e4", None, "A2", 1, 7)]
    return spark.createDataFrame(data, "event_id string, user_id string, sku string, qty int, amount int")


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [("u1", "Aki", "Tokyo"), ("u2", "Mina", "Osaka"), ("u3", "Ken", "Tokyo")],
        "user_id string, user_name string, prefecture string")


def test_masks_and_row_policy(fact):
    mask = {"user_id": governance.Mask(frozenset({"admin"}))}
    policy = governance.RowPolicy(frozenset({"admin"}), {"analyst": F.col("sku").like("A%")})
    assert rows(governance.governed(fact, "admin", policy, mask)) == rows(fact)
    seen = governance.governed(fact, "analyst", policy, mask)
    assert rows(seen.select("event_id", "user_id")) == [("e1", "**"), ("e2", "**"), ("e4", None)]
    assert governance.governed(fact, "guest", policy, mask).count() == 0
    # The policy sees the true value even when its own column is masked.
    both = governance.governed(fact, "analyst", policy, {"sku": mask["user_id"]})
    assert both.count() == 3 and {r.sku for r in both.collect()} == {"**"}


def test_published_table_has_only_the_listed_columns(spark, fact, tmp_path):
    governance.publish(fact, ["sku", "qty"], str(tmp_path / "public"))
    assert spark.read.parquet(str(tmp_path / "public")).columns == ["sku", "qty"]


def test_outer_joins(fact, users):
    for limit in (100, 0):
        right = joins.keep_lookup_rows(fact, users, "user_id", limit)
        assert rows(right.select("event_id", "user_id", "user_name")) == rows(
            fact.join(users, "user_id", "right").select("event_id", "user_id", "user_name"))
        alone = joins.unmatched(fact, users, "user_id", "dim_user_id", limit)
        assert rows(alone.select("event_id", "dim_user_id")) == sorted(
            [("e3", None), ("e4", None), (None, "u3")], key=repr)


def test_totals(fact):
    for limit in (100, 0):
        found = with_totals(fact, ["sku"], {"t": F.sum("amount")}, limit)
        assert rows(found.select("event_id", "sku", "t")) == [
            ("e1", "A1", 20), ("e1", "B1", 25), ("e2", "A1", 20), ("e3", "B1", 25), ("e4", "A2", 7)]
        by_user = with_totals(fact, ["user_id"], {"t": F.sum("amount")}, limit)
        assert rows(by_user.select("event_id", "t"))[-1] == ("e4", 7)  # NULL is a key too
        assert by_user.columns == [*fact.columns, "t"]
    assert {r.t for r in with_totals(fact, [], {"t": F.sum("amount")}).collect()} == {52}


def model(fact, users):
    return MetricModel(
        fact=fact, tables={"users": users}, keys={"users": "user_id"},
        relationships=[Relationship("user_id", "users")],
        dimensions={"sku_dim": Dimension("sku"), "place": Dimension("prefecture", "users"),
                    "name": Dimension("user_name", "users")},
        metrics={"sales": F.sum("amount"), "orders": F.count_distinct("event_id"),
                 "top": F.max("amount"), "double_qty": F.sum("twice")},
        facts={"twice": F.col("qty") * 2})


def test_metric_model(fact, users):
    m = model(fact, users)
    assert rows(m.query(["sales", "orders"], ["place"])) == [("Osaka", 10, 1), ("Tokyo", 15, 1)]
    assert rows(m.query(["double_qty"], ["sku_dim"])) == [("A1", 6), ("A2", 2), ("B1", 10)]
    assert rows(m.query(["top"])) == [(20,)]
    assert rows(m.query(["sales"], ["sku_dim"], equal={"place": "Tokyo"})) == [("A1", 10), ("B1", 5)]
    # A query by fact dimensions only must not lose rows without a user.
    assert rows(m.query(["sales"], ["sku_dim"])) == [("A1", 20), ("A2", 7), ("B1", 25)]
    assert "Join" not in m.query(["sales"], ["sku_dim"])._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(KeyError):
        m.query(["profit"], ["place"])


def test_metric_model_refuses_keys_that_fan_out(fact, users):
    m = model(fact, users.union(users))
    with pytest.raises(ValueError, match="not unique"):
        m.query(["sales"], ["place"])
    assert m.query(["sales"], ["sku_dim"]).count() == 3


def test_quality(spark, fact):
    assert rows(quality.null_counts(fact, ["event_id", "user_id"])) == [("event_id", 0), ("user_id", 1)]
    assert rows(quality.duplicate_keys(fact, ["event_id"])) == [("e1", 2)]
    assert quality.empty_alert(fact, "empty").count() == 0
    assert rows(quality.empty_alert(fact.where("false"), "empty")) == [("empty",)]
    assert rows(quality.distinct_count_mismatch(fact, {"sku": 3, "event_id": 9})) == [("event_id", 4, 9)]
    drift = spark.createDataFrame([("a", "x", 1), ("a", "x", 1), ("b", "x", 1), ("b", None, 1)],
                                  "sku string, name string, n int")
    assert rows(quality.inconsistent_attributes(drift, "sku", ["name"])) == [("b", 2)]


def ranges(spark, *pairs):
    return spark.createDataFrame([(f"f{i}", *p) for i, p in enumerate(pairs)], "file string, low int, high int")


def brute_force(pairs):
    overlaps = [sum(1 for j, (a, b) in enumerate(pairs) if j != i and a <= high and b >= low)
                for i, (low, high) in enumerate(pairs)]
    depth = [sum(1 for a, b in pairs if a <= low <= b) for low, _ in pairs]
    n = len(pairs)
    return (n, sum(a == b for a, b in pairs), round(sum(overlaps) / n, 4), round(sum(depth) / n, 4))


@pytest.mark.parametrize("pairs", [
    [(1, 2), (3, 4), (5, 6)],
    [(1, 9), (1, 9), (1, 9)],
    [(1, 3), (2, 5), (4, 6), (6, 6), (6, 8)],
    [(0, 10), (1, 1), (1, 2), (2, 9), (11, 12), (5, 5)],
])
def test_overlap_report(spark, pairs):
    assert tuple(layout.overlap_report(ranges(spark, *pairs)).first()) == brute_force(pairs)


def test_clustered_write_prunes_and_keeps_rows(spark, tmp_path):
    days = F.timestamp_add("DAY", F.pmod(F.col("id") * 7919, F.lit(100)).cast("int"),
                           F.lit("2026-01-01").cast("timestamp_ntz"))
    df = spark.range(4000).select(
        F.col("id").cast("string").alias("event_id"),
        # A third of all rows fall on one day.
        F.when(F.col("id") % 3 == 0, F.lit("2026-02-01").cast("timestamp_ntz")).otherwise(days)
        .alias("event_time"), (F.col("id") % 5).cast("string").alias("category"))
    plain, sorted_ = str(tmp_path / "plain"), str(tmp_path / "clustered")
    df.repartition(8).write.parquet(plain)
    day = F.to_date("event_time")
    layout.clustered(df, [day, F.col("category")], ["event_id"], 500).write.parquet(sorted_)
    before, after = spark.read.parquet(plain), spark.read.parquet(sorted_)
    assert rows(after) == rows(before)
    biggest = after.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert biggest < 1000
    worse = layout.clustering_report(before, day).first()
    better = layout.clustering_report(after, day).first()
    assert worse.average_overlaps == 7 and better.average_overlaps < 3
    # A day lives in fewer files, so statistics can skip the rest.
    wanted = F.col("event_time") == F.lit("2026-03-15").cast("timestamp_ntz")
    count = lambda d: d.where(wanted).select(F.input_file_name()).distinct().count()
    assert count(after) < count(before)


def test_scalar_functions(spark):
    df = spark.createDataFrame([(12000, 0), (3000, 2), (1, 1)], "amount int, n int")
    got = df.select(tier(F.col("amount"), [(10000, "high"), (3000, "mid")], "low").alias("t"),
                    safe_divide(F.col("amount"), F.col("n")).alias("q")).collect()
    assert [tuple(r) for r in got] == [("high", None), ("mid", 1500.0), ("low", 1.0)]


def test_amount_formats_agree(spark):
    df = spark.createDataFrame([(12345.99,), (0.5,), (-1234.9,), (None,)], "x double")
    got = df.select(udfs.format_amount_jpy(F.col("x")), udfs.format_amount_jpy_udf("x")).collect()
    assert [r[0] for r in got] == [r[1] for r in got] == ["¥12,345", "¥0", "¥-1,234", None]


def test_scaler_and_line(spark):
    df = spark.createDataFrame([(float(x), 3.0 * x + 2) for x in range(10)], "x double, y double")
    scaled = ml.fit_scaler(df, ["x"]).transform(df)
    mean, deviation = scaled.agg(F.avg("x_scaled"), F.stddev_pop("x_scaled")).first()
    assert abs(mean) < 1e-12 and abs(deviation - 1) < 1e-12
    sample = ml.fit_scaler(df, ["x"], population=False)
    assert sample.deviations["x"] > ml.fit_scaler(df, ["x"]).deviations["x"]
    line = ml.fit_line(df, ["x"], "y")
    assert abs(line.coefficients[0] - 3) < 1e-6 and abs(line.intercept - 2) < 1e-6


def test_line_is_one_aggregate(spark):
    tracker = spark.sparkContext.statusTracker()
    x = F.col("id").cast("double")
    df = spark.range(0, 1000, 1, 4).select(x.alias("x"), (x % 7).alias("z"), F.lit(5.0).alias("same"), (3 * x - 2 * (x % 7) + 4).alias("y"))
    spark.sparkContext.setJobGroup("line", "line")
    line = ml.fit_line(df, ["x", "z", "same"], "y")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = tracker.getJobIdsForGroup("line")
    stages = {s for j in jobs for s in tracker.getJobInfo(j).stageIds}
    assert len(stages) <= 3, stages  # the scan, and the merge of its partial results
    assert all(abs(a - b) < 1e-6 for a, b in zip((*line.coefficients, line.intercept), (3, -2, 0, 4)))
    off = line.transform(df).agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert off < 1e-6
    for bad in (None, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            ml.fit_line(df.withColumn("y", F.when(F.col("x") == 3, F.lit(bad)).otherwise(F.col("y"))), ["x"], "y")
