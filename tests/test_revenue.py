from documents import product, session, shop, transaction, user
from souk.operators import flatten, revenue


def orders(spark):
    return shop(
        spark,
        users=[user("u1"), user("u2", state="Western")],
        products=[product("p1", "Kawa"), product("p2", "Icyayi", "cat_2", "sub_3"), product("p3", "Kawa")],
        transactions=[
            transaction(1, "u1", [("p1", 1, 10.0), ("p1", 2, 12.0)], discount=4.0),
            transaction(2, "u1", [("p1", 1, 11.0)], status="shipped", ts="2025-03-01T00:00:00"),
            transaction(3, "u2", [("p9", 1, 50.0)]),
            transaction(4, "u2", [("p2", 1, 99.0)], status="refunded", method="visa_card"),
            transaction(5, "u2", [("p3", 1, 1.0)], ts="2025-03-02T00:00:00"),
        ],
    )


def test_lines_and_orders_are_counted_apart(spark):
    s = orders(spark)
    enriched = flatten.enrich_products(s.products, s.categories, s.subcategories)
    by_line = {r.product_id: r for r in revenue.top_products_lines(s.lines, enriched).collect()}
    assert (by_line["p1"].order_count, by_line["p1"].total_units, by_line["p1"].total_revenue) == (2, 3, 34.0)
    assert (by_line["p9"].product_name, by_line["p9"].category) == (None, None)
    assert "p2" not in by_line
    by_order = {r.product_id: r for r in revenue.top_products_orders(s.lines).collect()}
    assert (by_order["p1"].order_count, by_order["p1"].total_units, by_order["p1"].avg_price) == (2, 4, 11.0)
    assert [r.product_id for r in revenue.product_revenue(s.lines).collect()] == ["p9", "p1", "p3"]


def test_names_group_together_and_fall_back_to_ids(spark, rows):
    s = orders(spark)
    got = revenue.top_product_names(s.lines, s.products).select("product_name", "revenue", "units")
    assert rows(got) == [("Kawa", 46.0, 5), ("p9", 50.0, 1)]


def test_unknown_products_in_category_reports(spark, rows):
    s = orders(spark)
    inner = revenue.category_revenue(s.lines, flatten.with_category(s.products, s.categories))
    assert rows(inner) == [("Fresh Produce", 46.0, 5, 2)]
    chart = revenue.category_revenue_top(s.lines, s.products, s.categories)
    assert rows(chart) == [("Fresh", 46.0, 5), ("Other", 50.0, 1)]


def test_months(spark, rows):
    s = orders(spark)
    assert rows(revenue.monthly_revenue(s.transactions)) == [
        ("2025-02", 2, 80.0, 40.0, 4.0, 4.8),
        ("2025-03", 2, 12.0, 6.0, 0.0, 0.0),
    ]
    periods = revenue.monthly_revenue_period(s.transactions)
    assert rows(periods) == [("2025-02", 80.0, 2, 40.0, 4.0), ("2025-03", 12.0, 2, 6.0, 0.0)]
    growth = revenue.monthly_growth(s.transactions)
    assert rows(growth) == [("2025-02", 80.0, None, None), ("2025-03", 12.0, 80.0, -85.0)]


def test_payment_mix_counts_refunds(spark, rows):
    got = revenue.payment_mix(orders(spark).transactions)
    assert rows(got) == [("cash", 4, 92.0), ("visa_card", 1, 99.0)]


def test_provinces(spark, rows):
    s = orders(spark)
    assert rows(revenue.province_revenue(s.transactions, s.users)) == [("Kigali", 1, 2, 41.0), ("Western", 1, 2, 51.0)]


def test_daily_sales(spark, rows):
    got = revenue.daily_product_sales(orders(spark).lines).where("product_id = 'p1'")
    assert rows(got) == [("p1", "2025-02-01", 3, 34.0), ("p1", "2025-03-01", 1, 11.0)]


def test_kpis(spark):
    s = shop(
        spark,
        transactions=[transaction(1, "u", [("p", 1, 1234567.5)]), transaction(2, "u", [("p", 1, 1.0)], "refunded")],
        sessions=[session(1, "u", status="converted"), session(2, "u")],
    )
    row = revenue.kpi_summary(s.transactions, s.sessions).first()
    assert tuple(row) == (1234568.5, "RWF 1,234,569", 50.0, 617284.25)
    empty = revenue.kpi_summary(s.transactions.limit(0), s.sessions.limit(0)).first()
    assert (empty.total_revenue, empty.conversion_rate_pct) == (None, 0.0)
