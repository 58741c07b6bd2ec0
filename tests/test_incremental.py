"""Figures by batches: equal to a full run, and only the touched days are read and written."""

import random
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from souk.operators import customers, products
from souk.plans.incremental import StoredFigures

SCHEMAS = {
    "page_views": "user_id string, ts timestamp, page_type string, product_id string, view_duration bigint",
    "cart": "product_id string, started_at timestamp, quantity bigint",
    "lines": "product_id string, ts timestamp, status string, quantity bigint, subtotal decimal(12,2)",
    "transactions": "user_id string, ts timestamp, status string, total decimal(12,2)",
}


def batch(spark, seed, days, n=40):
    r = random.Random(seed)

    def ts():
        day = r.choice(days)
        return None if day is None else datetime(2025, 1, 1) + timedelta(days=day, seconds=r.randrange(86400))

    def status():
        return r.choice(["completed", "shipped", "refunded"])

    def product():
        return f"p{r.randrange(4)}"

    def user():
        return r.choice([None, *(f"u{k}" for k in range(9))])

    rows = {
        "page_views": [(user(), ts(), r.choice(["product_detail", "home"]), r.choice([None, product()]), r.choice([None, 5, 7])) for _ in range(n)],
        "cart": [(product(), ts(), r.randrange(1, 4)) for _ in range(n)],
        "lines": [(product(), ts(), status(), r.randrange(1, 5), Decimal(r.randrange(9999)) / 100) for _ in range(n)],
        "transactions": [(user(), ts(), status(), Decimal(r.randrange(9999)) / 100) for _ in range(n)],
    }
    return {name: spark.createDataFrame(rows[name], SCHEMAS[name]) for name in SCHEMAS}


def store(spark, path, period="day"):
    return StoredFigures(spark, str(path), {name: spark.createDataFrame([], s).schema for name, s in SCHEMAS.items()}, period)


def listed(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("period", ["day", "month"])
def test_batches_equal_a_full_run(spark, tmp_path, period):
    figures = store(spark, tmp_path, period)
    batches = [batch(spark, 1, [0, 1, None]), batch(spark, 2, [1, 2, 40]), batch(spark, 3, [None])]
    assert listed(figures.product_performance()) == listed(figures.purchase_summary()) == []
    for k, inputs in enumerate(batches):
        figures.add(k, **inputs)
    figures.add(1, **batches[1])  # run again
    whole = {name: batches[0][name].union(batches[1][name]).union(batches[2][name]) for name in SCHEMAS}
    full = products.product_performance(whole["page_views"], whole["cart"], whole["lines"])
    again = store(spark, tmp_path, period)  # nothing is kept but the files
    assert listed(again.product_performance()) == listed(full.select(*again.product_performance().columns))
    views = whole["page_views"].where("page_type = 'product_detail' AND product_id IS NOT NULL")
    users = views.groupBy("product_id", F.date_format(F.date_trunc("month", "ts"), "yyyy-MM-dd").alias("since")).agg(
        F.count_distinct("user_id").alias("user_count")
    )
    assert listed(again.product_users()) == listed(users)  # sketches of so few are exact
    assert listed(again.purchase_summary()) == listed(customers.purchase_summary(whole["transactions"]))


def test_only_touched_days_are_read_and_written(spark, tmp_path):
    figures = store(spark, tmp_path)
    assert figures.add(0, **batch(spark, 4, [0, 1])) == ["2025-01-01", "2025-01-02"]
    before = {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet") if "=2025-01-01" in str(p)}
    for path in before:
        if "/rows/" in str(path):
            path.write_bytes(b"no Parquet")  # a read of the first day would fail
            (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    before = {p: p.stat().st_mtime_ns for p in before}
    assert figures.add(1, **batch(spark, 5, [1, 2])) == ["2025-01-02", "2025-01-03"]
    after = {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet") if "=2025-01-01" in str(p)}
    assert before and after == before
    days = {r.day for r in figures.product_performance().collect()}
    assert days == {"2025-01-01", "2025-01-02", "2025-01-03"}


def test_one_input_touches_only_its_figures(spark, tmp_path):
    figures = store(spark, tmp_path)
    figures.add(0, **batch(spark, 6, [0]))
    performance = listed(figures.product_performance())
    assert figures.add(1, transactions=batch(spark, 7, [0, 5])["transactions"]) == ["2025-01-01", "2025-01-06"]
    assert listed(figures.product_performance()) == performance
    assert figures.add(2, transactions=batch(spark, 7, [0], n=0)["transactions"]) == []


def test_sketches_of_days_add_up(spark):
    views = spark.range(60_000).selectExpr(
        "concat('u', id % 20000) AS user_id",
        "timestamp'2025-01-01 00:00:00' + make_dt_interval(int(id % 45)) AS ts",
        "'product_detail' AS page_type",
        "concat('p', id % 3 % 2) AS product_id",
    )
    exact = views.groupBy("product_id", F.date_format(F.date_trunc("month", "ts"), "yyyy-MM-dd").alias("since")).agg(
        F.count_distinct("user_id").alias("exact")
    )
    got = products.users_of_sketches(products.product_user_sketches(views), "month")
    both = got.join(exact, ["product_id", "since"]).collect()
    assert len(both) == exact.count() == got.count() > 2
    assert all(abs(r.user_count - r.exact) <= 0.07 * r.exact for r in both)


def test_weeks_begin_on_mondays(spark):
    day = "timestamp'2025-01-05 10:00:00', timestamp'2025-01-06 10:00:00'"
    views = spark.sql(f"SELECT 'u' AS user_id, explode(array({day})) AS ts, 'product_detail' AS page_type, 'p' AS product_id")
    got = products.users_of_sketches(products.product_user_sketches(views), "week")
    assert sorted((r.since, r.user_count) for r in got.collect()) == [("2024-12-30", 1), ("2025-01-06", 1)]
