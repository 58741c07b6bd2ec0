import random

import numpy as np
import pytest

from documents import session, shop, transaction, user
from souk.functions.quantiles import exact_percentile
from souk.operators import customers


def orders_of(**counts):
    numbers = iter(range(1000))
    return [transaction(next(numbers), u, [("p", 1, 10.0)]) for u, n in counts.items() for _ in range(n)]


def test_segments(spark, rows):
    s = shop(
        spark,
        users=[user(u) for u in ("u0", "u1", "u2", "u4", "u5")],
        transactions=orders_of(u1=1, u2=2, u4=4, u5=5) + [transaction(2000, "u0", [("p", 1, 1.0)], "processing")],
    )
    assert rows(customers.buyer_segments(s.transactions)) == [
        ("High-Frequency", 1, 50.0, 5.0),
        ("One-Time", 1, 10.0, 1.0),
        ("Regular", 2, 30.0, 3.0),
    ]
    assert rows(customers.user_segments(s.users, s.transactions)) == [
        ("High-Frequency (5+)", 1, 20.0, 50.0),
        ("Inactive", 1, 20.0, 0.0),
        ("One-Time", 1, 20.0, 10.0),
        ("Regular (2-4)", 2, 40.0, 30.0),
    ]
    assert rows(customers.inactive_users(s.users, s.transactions)) == [("u0",)]


def test_empty_segments_are_listed(spark):
    s = shop(spark, users=[user("u0")])
    got = {r.segment: (r.user_count, r.avg_spend) for r in customers.user_segments(s.users, s.transactions).collect()}
    assert len(got) == 4 and got["Inactive"] == (1, 0.0) and got["One-Time"] == (0, 0.0)


def test_cohorts(spark, rows):
    s = shop(
        spark,
        users=[user("u1", "2025-01-15T00:00:00"), user("u2", "2025-01-20T00:00:00"), user("bad", "soon")],
        transactions=[
            transaction(1, "u1", [("p", 1, 5.0)], ts="2024-12-31T00:00:00"),
            transaction(2, "u1", [("p", 1, 10.0)]),
            transaction(3, "u1", [("p", 1, 20.0)]),
            transaction(4, "u2", [("p", 1, 1.0)]),
            transaction(5, "u2", [("p", 1, 1.0)], "refunded"),
            transaction(6, "bad", [("p", 1, 9.0)]),
            transaction(7, "who", [("p", 1, 9.0)]),
        ],
    )
    cohorts = customers.cohort_spend(s.users, s.transactions)
    assert rows(cohorts) == [("2025-01", -1, 1, 5.0, 1, 5.0), ("2025-01", 1, 2, 31.0, 3, 15.5)]
    assert rows(customers.cohort_pivot(cohorts)) == [("2025-01", 0.0, 31.0, 0.0)]


def test_purchase_summary(spark, rows):
    s = shop(
        spark,
        transactions=[
            transaction(1, "u", [("p", 1, 5.0)], ts="2025-01-02T03:04:05"),
            transaction(2, "u", [("p", 1, 6.0)], ts="2025-01-01T00:00:00"),
        ],
    )
    assert rows(customers.purchase_summary(s.transactions)) == [("u", 2, 11.0, 5.5, "2025-01-02T03:04:05")]


def value(spark, users, transactions, sessions=(), **options):
    s = shop(spark, users=users, transactions=transactions, sessions=sessions)
    return {r.user_id: r for r in customers.clv(s.users, s.transactions, s.sessions, **options).collect()}


def test_clv_formula(spark):
    visits = [
        session(i, "u", seconds=900, status="converted" if i == 0 else "browsing") for i in range(4)
    ] + [session(9, "visitor")]
    got = value(
        spark,
        [user("u", "2025-09-01T00:00:00"), user("visitor")],
        [transaction(1, "u", [("p", 1, 1200.0)])],
        visits,
        ref_date="2026-03-07",
    )
    row = got["u"]
    assert list(got) == ["u"]
    assert (row.avg_monthly_revenue, row.engagement_score, row.clv_estimate, row.clv_segment) == (
        200.0,
        0.75,
        990.0,
        "High",
    )
    short = value(spark, [user("u", "2025-09-01T00:00:00")], [transaction(1, "u", [("p", 1, 1200.0)])], visits, use_duration=False)
    assert short["u"].engagement_score == 0.5


@pytest.mark.parametrize(
    ("registered", "months"),
    [
        ("2025-01-01T12:00:00", 14),
        ("soon", 1),
        ("2026-03-01T00:00:00", 1),
        ("2027-01-01T00:00:00", 1),
        (None, 3),
    ],
)
def test_tenure(spark, registered, months):
    users = [user("u", registered)] if registered else [user("other")]
    got = value(spark, users, [transaction(1, "u", [("p", 1, 840.0)])])
    assert got["u"].avg_monthly_revenue == 840.0 / months
    assert got["u"].engagement_score == 0.0


def test_segment_limits_are_strict(spark):
    new = [user("a", "2026-03-01T00:00:00"), user("b", "2026-03-01T00:00:00")]
    got = value(spark, new, [transaction(1, "a", [("p", 1, 138.89)]), transaction(2, "b", [("p", 1, 41.67)])], high=500.0)
    assert (got["a"].clv_estimate, got["b"].clv_estimate) == (500.0, 150.01)
    limits = value(
        spark, new, [transaction(1, "a", [("p", 1, 138.89)]), transaction(2, "b", [("p", 1, 41.67)])], medium=150.01
    )
    assert (limits["a"].clv_segment, limits["b"].clv_segment) == ("Medium", "Low")


def estimates(spark, values):
    return spark.createDataFrame([(f"u{i}", float(v)) for i, v in enumerate(values)], "user_id string, clv_estimate double")


def test_histogram(spark):
    values = [random.Random(1).gauss(100, 20) for _ in range(500)] + [1000.0]
    got = customers.clv_histogram(estimates(spark, values)).collect()
    assert [r.users for r in got] == list(np.histogram(values, 30)[0])
    assert len(got) == 30


def test_histogram_of_one_value_and_of_nothing(spark):
    same = customers.clv_histogram(estimates(spark, [5.0] * 7)).collect()
    assert sorted(r.users for r in same) == [0] * 29 + [7] and same[0].mean_clv == 5.0
    nothing = customers.clv_histogram(estimates(spark, [5.0]).limit(0)).collect()
    assert sum(r.users for r in nothing) == 0 and len(nothing) == 30


@pytest.mark.parametrize("p", [0.0, 0.8, 0.999, 1.0])
@pytest.mark.parametrize("n", [1, 7, 1492, 30_000])
def test_exact_percentile(spark, n, p):
    rng = random.Random(n)
    # A third of all values are equal.
    values = [100.0 if rng.random() < 1 / 3 else round(rng.lognormvariate(5, 2), 2) for _ in range(n)]
    got = exact_percentile(spark.createDataFrame([(v,) for v in values], "v double").repartition(4), "v", p)
    assert got == pytest.approx(np.percentile(values, p * 100), rel=1e-12)


def test_percentile_of_nothing(spark):
    assert exact_percentile(spark.createDataFrame([], "v double"), "v", 0.5) is None


def test_concentration(spark):
    row = customers.clv_concentration(estimates(spark, [1, 1, 1, 1, 1, 1, 1, 1, 40, 60])).first()
    assert (row.top_users, row.all_users) == (2, 10)
    assert row.top_value_share == pytest.approx(100 / 108)


def test_value_segments_and_top(spark, rows):
    s = shop(spark, transactions=orders_of(a=1, b=30))
    found = customers.clv(s.users, s.transactions, s.sessions)
    assert rows(customers.clv_segments(found)) == [("Low", 1, 12.0, 12.0), ("Medium", 1, 360.0, 360.0)]
    assert [r.user_id for r in customers.clv_top(found, 1).collect()] == ["b"]
