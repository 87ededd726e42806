"""Bad-record modes, the event generator, nesting and table lifecycle."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from martlet.operators.ordered import asc
from martlet.operators.variant import flatten_with_meta, nest, path
from martlet.sources import generator, ingest, tables


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "good.json").write_text('{"event_id": "a"}\n\n{"event_id": "b"}\n')
    (tmp_path / "bad.json").write_text('{"event_id": "c"}\n{"event_id":\n')
    (tmp_path / "array.json").write_text('[{"event_id": "d"}, {"event_id": "e"}]\n')
    return str(tmp_path)


def ids(raw):
    return {r[0] for r in raw.select(path("raw", "event_id")).collect()}


def test_continue_drops_bad_lines(spark, folder):
    raw = ingest.read_json_events(spark, folder, "continue")
    assert raw.count() == 4 and ids(raw) == {"a", "b", "c", None}
    assert raw.select("loaded_at").distinct().count() == 1
    assert rows(ingest.rows_per_file(raw)) == [("array.json", 1), ("bad.json", 1), ("good.json", 2)]
    assert [r.line for r in ingest.rejected(ingest.read_lines(spark, folder)).collect()] == ['{"event_id":']


def test_abort_fails(spark, folder):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        ingest.read_json_events(spark, folder, "abort").count()
    assert ingest.read_json_events(spark, f"{folder}/good.json", "abort").count() == 2


def test_skip_file_drops_the_whole_file(spark, folder):
    assert ids(ingest.read_json_events(spark, folder, "skip_file")) == {"a", "b", None}


def test_skip_file_keeps_lines_without_a_file(spark):
    lines = spark.createDataFrame(
        [("{}", None), ("{bad", None), ("{}", "x"), ("{bad", "x"), ("{}", "y")],
        "line string, src_path string")
    assert rows(ingest.to_raw(lines, "skip_file").select(F.to_json("raw"), "src_path")) == sorted(
        [("{}", "y"), ("{}", None)], key=repr)


def test_unknown_mode(spark, folder):
    with pytest.raises(ValueError):
        ingest.read_json_events(spark, folder, "ignore")


def test_generated_events_are_reproducible(spark):
    first = generator.generate_events(spark.range(800))
    text = lambda df: rows(df.select(F.to_json("raw")))
    assert text(first) == text(generator.generate_events(spark.range(800).repartition(7)))
    assert text(first) != text(generator.generate_events(spark.range(800), seed=1))
    events = first.select(
        path("raw", "event_id").alias("id"), path("raw", "user_id").alias("user"),
        path("raw", "items[0].sku").alias("sku"), path("raw", "items[0].category").alias("category"),
        path("raw", "items[0].qty", "int").alias("qty"),
        path("raw", "items[0].price", "int").alias("price"))
    got = events.agg(
        F.count_distinct("id"), F.min("user"), F.max("user"), F.min("sku"), F.max("sku"),
        F.count_distinct("category"), F.min("qty"), F.max("qty"), F.min("price") >= 100,
        F.max("price") <= 9999).first()
    assert tuple(got) == (800, "u001", "u030", "SKU0001", "SKU0100", 5, 1, 3, True, True)
    assert ("SKU0001", "Sports") in {(r.sku, r.category) for r in events.collect()}


def test_nest_splits_large_documents(spark):
    lines = spark.range(250).select(
        F.when(F.col("id") < 200, "big").otherwise("small").alias("k"), F.col("id").alias("n"))
    for limit in (10_000, 40):
        nested = nest(lines, ["k"], ["n"], asc("n"), {"top": F.max("n")}, max_items=60,
                      rows_per_segment=limit)
        got = [(r.k, len(r["items"]), [i.n for i in r["items"]]) for r in nested.collect()]
        assert sorted((k, n) for k, n, _ in got) == [
            ("big", 20), ("big", 60), ("big", 60), ("big", 60), ("small", 50)]
        assert sorted(x for _, _, part in got for x in part) == list(range(250))
        assert all(part == sorted(part) for _, _, part in got)


def test_flatten_metadata(spark):
    docs = [{"id": "a", "v": [5, 6]}, {"id": "b", "v": {"x": 1, "y": 2}}, {"id": "c", "v": []}]
    raw = spark.createDataFrame([(json.dumps(d),) for d in docs], "j string").select(
        F.parse_json("j").alias("raw")).withColumn("id", path("raw", "id"))
    flat = flatten_with_meta(raw, "id", "v")
    got = rows(flat.select("id", "key", "path", "index", F.to_json("value"), F.to_json("this")))
    assert got == sorted([
        ("a", None, "[0]", 0, "5", "[5,6]"), ("a", None, "[1]", 1, "6", "[5,6]"),
        ("b", "x", "x", None, "1", '{"x":1,"y":2}'), ("b", "y", "y", None, "2", '{"x":1,"y":2}'),
    ], key=repr)
    per_row = flat.groupBy("id").agg(F.count_distinct("seq")).collect()
    assert all(r[1] == 1 for r in per_row)
    assert flat.select("seq").distinct().count() == 2


def test_table_lifecycle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS life LOCATION '{tmp_path}/life'")
    name = "life.sample_products"
    tables.create_table(
        spark, name,
        "product_id BIGINT NOT NULL, product_name STRING NOT NULL, price DECIMAL(10,2) NOT NULL, "
        "in_stock BOOLEAN DEFAULT true, created_at TIMESTAMP_NTZ DEFAULT localtimestamp()")
    spark.sql(f"INSERT INTO {name} (product_id, product_name, price) VALUES (1, 'Mat', 9.5)")
    row = spark.table(name).first()
    assert row.in_stock is True and row.created_at is not None
    tables.add_column(spark, name, "category STRING")
    tables.insert_select(spark.table(name), name)
    assert spark.table(name).count() == 2
    tables.drop_column(spark, name, "in_stock")
    tables.rename_column(spark, name, "product_name", "name")
    assert spark.table(name).columns == ["product_id", "name", "price", "created_at", "category"]
    tables.rename_table(spark, name, "life.sample_products_v2")
    tables.truncate_table(spark, "life.sample_products_v2")
    assert spark.table("life.sample_products_v2").count() == 0
    tables.drop_table(spark, "life.sample_products_v2")
    tables.drop_table(spark, "life.sample_products_v2")
    assert not spark.catalog.tableExists("life.sample_products_v2")

    tables.replace_table(spark.range(3), "life.summary")
    tables.replace_table(spark.range(5), "life.summary")
    assert spark.table("life.summary").count() == 5
    tables.replace_view(spark, "life.big", "SELECT * FROM life.summary WHERE id > 2")
    tables.replace_view(spark, "life.big", "SELECT * FROM life.summary WHERE id > 3")
    assert spark.table("life.big").count() == 1
    tables.drop_view(spark, "life.big")
    kept = tables.temporary_table(spark.range(4), "tmp_ids")
    assert spark.sql("SELECT count(*) FROM tmp_ids").first()[0] == 4
    kept.unpersist()
    tables.drop_table(spark, "life.summary")
    spark.sql("DROP DATABASE life")
