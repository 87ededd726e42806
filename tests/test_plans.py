"""Physical plans: what is pushed down, broadcast, cut, and never gathered in one task."""

import re

import pytest

from martlet.plans import load_catalogue
from martlet.plans.workspace import Workspace

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ws(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    return Workspace(spark, SMALL)


def plan(ws, name):
    return load_catalogue()[name].run(ws)._jdf.queryExecution().executedPlan().toString()


def test_star_joins_broadcast_small_dimensions(ws):
    text = plan(ws, "star_category_region")
    assert text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


def test_large_dimensions_are_not_broadcast(ws, spark):
    spark.conf.set("spark.martlet.broadcastRows", "10")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(ws, "star_category_region")
    finally:
        spark.conf.unset("spark.martlet.broadcastRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in text and text.count("SortMergeJoin") == 2
    # Sums per join key come first, so no key brings all its rows to the join.
    assert text.rindex("partial_sum") > text.rindex("SortMergeJoin")


def test_wide_rows_are_not_broadcast(ws, spark):
    from martlet.sizing import small_enough

    docs = ws.source("documents")
    assert small_enough(docs)
    spark.conf.set("spark.martlet.broadcastBytes", "10000")
    try:
        assert not small_enough(docs) and small_enough(docs.select("doc_id"), 1000)
    finally:
        spark.conf.unset("spark.martlet.broadcastBytes")


def test_time_filters_reach_the_scan(ws):
    for name in ("filter_time_range", "filter_recent_day", "pruned_day_sales"):
        pushed = re.search(r"PushedFilters: \[(.*?)\]", plan(ws, name)).group(1)
        assert "GreaterThanOrEqual(event_time" in pushed and "LessThan(event_time" in pushed


def test_only_needed_columns_are_read(ws):
    read = re.search(r"ReadSchema: struct<(.*?)>", plan(ws, "agg_by_category")).group(1)
    assert read == "category:string,line_amount:decimal(12,2)"


def test_filter_runs_below_the_generator(ws):
    text = plan(ws, "json_filter_explode")
    assert text.index("Generate variant_explode") < text.index("Filter")


def test_no_window_gathers_all_rows(ws, spark):
    """A window without partition keys may only see summaries or an already limited set."""
    spark.conf.set("spark.martlet.segmentRows", "500")
    try:
        for name in ("win_rownum_part", "win_ranks", "win_running_user", "win_lag_lead",
                     "win_moving_avg", "win_cum_share"):
            text = plan(ws, name)
            assert "_segment" in text and "Exchange SinglePartition" not in text, name
    finally:
        spark.conf.unset("spark.martlet.segmentRows")


def test_top_n_is_limited_before_the_shuffle(ws):
    assert "WindowGroupLimit" in plan(ws, "win_topn_part")
    assert "TakeOrderedAndProject" in plan(ws, "topk_recent")
    assert "Window" not in plan(ws, "win_top1")


def test_search_reads_only_its_terms(ws):
    assert re.search(r"PushedFilters: \[.*In\(term", plan(ws, "bm25_topk"))


def test_scalars_do_not_become_cross_joins(ws):
    for name in ("scalar_avg_diff", "above_average", "win_grand_total", "max_category"):
        text = plan(ws, name)
        assert "NestedLoop" not in text and "CartesianProduct" not in text, name
