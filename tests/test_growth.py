"""The work of a task does not grow with the input: larger inputs get more tasks, and the same rows."""

from datetime import datetime

import pytest

from souk.operators import baskets, products, revenue
from souk.plans import queries
from souk.sources import warehouse


@pytest.fixture
def shop_of(spark, tmp_path):
    def made(orders):
        folder = f"{tmp_path}/shop{orders}"
        spark.createDataFrame(
            [(k, k % 5, "FOP"[k % 3], datetime(2024, 1, 1 + k % 28), "2-HIGH") for k in range(orders)],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp, o_orderpriority string",
        ).write.parquet(f"{folder}/orders.parquet")
        spark.createDataFrame(
            [(None if k % 50 == 0 else k % orders, k % 7, k // orders, 1.0 + k % 3, 10.0 + k) for k in range(4 * orders)],
            "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double",
        ).write.parquet(f"{folder}/lineitem.parquet")
        return warehouse.Warehouse(spark, folder)

    return made


def test_tasks_of_order_lines_grow_with_them(monkeypatch, shop_of, rows):
    small, large = shop_of(200), shop_of(400)

    def reports(shop):
        lines = warehouse.Warehouse(shop.spark, shop.folder).lines
        return lines, rows(revenue.product_revenue(lines, "o_orderkey")), rows(revenue.top_products_orders(lines, 3, "o_orderkey"))

    before = [reports(small), reports(large)]
    monkeypatch.setattr(warehouse, "LINES_OF_TASK", 20)
    after = [reports(small), reports(large)]
    assert [x[1:] for x in before] == [x[1:] for x in after] and before[0][1]
    assert [x[0].rdd.getNumPartitions() for x in after] == [40, 80]


@pytest.mark.parametrize("block", [500, 4])
def test_tasks_of_pairs_grow_with_them(spark, monkeypatch, rows, block):
    def bought(users):
        drawn = spark.range(users * 12).selectExpr("concat('u', id div 12) AS basket", "concat('p', pmod(xxhash64(id), 40)) AS item")
        return drawn.distinct()

    def tasks(df):
        return baskets._pair_counts(baskets._numbered(df)[0], baskets._sizes(df), 3, True, 2_000, block)[0].rdd.getNumPartitions()

    sets = [bought(40), bought(80)]
    plain = [(rows(baskets.best_partners(s, block=block)), rows(baskets.top_pairs(s, block=block))) for s in sets]
    monkeypatch.setattr(baskets, "PAIRS_OF_TASK", 20)
    assert plain == [(rows(baskets.best_partners(s, block=block)), rows(baskets.top_pairs(s, block=block))) for s in sets]
    assert 1.6 < tasks(sets[1]) / tasks(sets[0]) < 2.5


def test_batches_read_inputs_that_were_computed_once(monkeypatch, shop_of, rows):
    shop = shop_of(50)
    lines = shop.lines.select(*queries.LINE_COLUMNS)
    added = []

    class Recorder(queries.StoredFigures):
        def add(self, batch_id, **inputs):
            added.append(inputs["lines"])
            return super().add(batch_id, **inputs)

    monkeypatch.setattr(queries, "StoredFigures", Recorder)
    none = [shop.spark.createDataFrame([], s) for s in (
        "user_id string, ts timestamp, page_type string, product_id string, view_duration bigint",
        "product_id string, started_at timestamp, quantity bigint",
    )]
    got = queries.in_two_batches(shop, page_views=none[0], cart=none[1], lines=lines).product_performance()
    assert all("batches-lines" in path for df in added for path in df.inputFiles()) and len(added) == 2
    assert sorted(rows(added[0]) + rows(added[1]), key=str) == rows(lines)
    assert rows(got) == rows(products.product_performance(*none, lines).select(*got.columns))
