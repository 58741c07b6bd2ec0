"""What the physical plans must and must not contain."""

from pathlib import Path

import pytest

from souk.plans.queries import queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


def plan(spark, name):
    return queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


LAZY = [n for n in queries() if not n.startswith("stream_")]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


@pytest.mark.parametrize("name", [n for n in LAZY if n.startswith(("top_", "copurchase", "coview", "clv_top", "product_funnel"))])
def test_best_of_lists_keep_only_n_rows_per_task(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


@pytest.mark.parametrize("name", ["recent_sessions_per_user", "keep_last_3_versions", "also_bought"])
def test_limits_per_key_apply_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_scans_read_only_needed_columns(spark):
    text = plan(spark, "product_purchases")
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_filters_reach_the_scan(spark):
    assert "EqualTo(event_type,view)" in plan(spark, "product_views")


def test_products_join_sums_not_lines(spark):
    text = plan(spark, "category_revenue")
    catalog_join = text.index("p_partkey")
    assert text.index("partial_sum") < catalog_join


SCANS = {
    ("session_keyed_table", "events"): 2,
    ("export_sessions", "events"): 2,
    ("product_performance", "events"): 3,
    ("product_performance", "part"): 0,
    ("product_cart_adds", "events"): 1,
    ("product_funnel", "events"): 2,
    ("top_products_lines", "lineitem"): 1,
    ("top_products_orders", "lineitem"): 1,
}


@pytest.mark.parametrize("name, table", SCANS)
def test_tables_are_scanned_no_more_often_than_needed(spark, name, table):
    scans = [line for line in plan(spark, name).splitlines() if "FileScan" in line and f"{table}.parquet" in line]
    assert len(scans) == SCANS[name, table]


@pytest.mark.parametrize("name", ["top_products_orders", "product_revenue"])
def test_orders_are_counted_where_the_join_placed_them(spark, name):
    """Lines, orders and products are exchanged once each, and the best rows once if all are sorted."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 3


def test_sessions_are_cut_without_sorting_events(spark):
    assert "SortAggregate" not in plan(spark, "sessionize_events")
