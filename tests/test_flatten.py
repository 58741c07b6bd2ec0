from documents import CATEGORIES, product, session, shop, transaction, user
from souk.functions import columns
from souk.operators import customers, flatten
from souk.schemas import PROVINCE_DISTRICTS
from pyspark.sql import functions as F


def test_enrichment_looks_up_the_subcategory_within_its_category(spark):
    s = shop(
        spark,
        products=[
            product("p1", "a", "cat_1", "sub_1"),
            product("p2", "b", "cat_1", "sub_3"),
            product("p3", "c", "cat_9", "sub_1"),
        ],
    )
    got = {
        r.product_id: (r.category_name, r.subcategory_name)
        for r in flatten.enrich_products(s.products, s.categories, s.subcategories).collect()
    }
    assert got == {
        "p1": ("Fresh Produce", "Fruits"),
        "p2": ("Fresh Produce", "Unknown"),
        "p3": ("Unknown", "Unknown"),
    }
    exported = {
        r.product_id: (r.category_name, r.subcategory_name)
        for r in flatten.export_products(s.products, s.categories, s.subcategories).collect()
    }
    assert exported == {"p1": ("Fresh Produce", "Fruits"), "p2": ("Fresh Produce", "Green Tea"), "p3": ("", "Fruits")}


def test_date_parts_of_unreadable_text(spark):
    s = shop(
        spark,
        transactions=[
            transaction(1, "u", [("p1", 1, 2.0), ("p2", 1, 3.0)], ts="2025-02-03T04:05:06"),
            transaction(2, "u", [], ts="bad-value-xyz"),
            transaction(3, "u", [], ts=None),
        ],
    )
    got = {
        r.transaction_id: (r.date, r.year, r.month, r.month_name, r.item_count)
        for r in flatten.export_transactions(s.transactions).collect()
    }
    assert got == {
        "t1": ("2025-02-03", 2025, 2, "February", 2),
        "t2": ("bad-value-", None, None, None, 0),
        "t3": (None, None, None, None, 0),
    }


def test_items_fall_back_to_the_product_id(spark, rows):
    s = shop(
        spark,
        products=[product("p1", "Kawa")],
        transactions=[transaction(1, "u", [("p1", 2, 1.5), ("p9", 1, 3.0)]), transaction(2, "u", [])],
    )
    got = flatten.export_transaction_items(s.lines, s.products)
    picked = got.select("transaction_id", "product_id", "product_name", "item_subtotal_rwf")
    assert rows(picked) == [("t1", "p1", "Kawa", 3.0), ("t1", "p9", "p9", 3.0)]


def test_session_export_counts_cart_products(spark):
    s = shop(spark, sessions=[session(1, "u", cart={"p1": (2, 1.5), "p2": (1, 3.0)}, seconds=90)])
    row = flatten.export_sessions(s.session_cells).first()
    assert (row.cart_item_count, row.page_view_count, row.duration_minutes, row.province) == (2, 1, 1.5, "Kigali")


def test_users_without_orders_export_zeros(spark, rows):
    s = shop(spark, users=[user("u1"), user("u2")], transactions=[transaction(1, "u1", [("p", 3, 10.0)])])
    users = s.users.drop("total_orders", "total_spent", "avg_order")
    got = flatten.export_users(users, customers.purchase_summary(s.transactions))
    picked = got.select("user_id", "province", "total_orders", "total_spent_rwf", "avg_order_rwf")
    assert rows(picked) == [("u1", "Kigali", 1, 30.0, 30.0), ("u2", "Kigali", 0, 0.0, 0.0)]


def test_categories_have_one_row_per_subcategory(spark):
    s = shop(spark, categories=CATEGORIES)
    assert flatten.export_categories(s.categories, s.subcategories).count() == 3


def test_carts_become_orders(spark, rows):
    cart = {"p1": (2, 1.5), "p2": (1, 3.0)}
    s = shop(
        spark,
        sessions=[
            session(1, "u", cart=cart, status="converted"),
            session(2, "u", status="converted"),
            session(3, "u", cart=cart, status="abandoned"),
        ],
    )
    orders = flatten.orders_from_carts(s.cart, 0.1)
    picked = orders.selectExpr("session_id", "line_count", "double(subtotal)", "double(discount)", "double(total)")
    assert rows(picked) == [("s1", 2, 6.0, 0.6, 5.4)]
    assert flatten.order_lines_from_carts(s.cart).count() == 2


def test_provinces(spark):
    cities = [(c, p) for p, cs in PROVINCE_DISTRICTS.items() for c in cs] + [("Nowhere", None)]
    df = spark.createDataFrame(cities, "city string, province string")
    assert df.where(~flatten.province_of(F.col("city")).eqNullSafe(F.col("province"))).count() == 0
    assert len(cities) == 31


def test_labels(spark):
    df = spark.createDataFrame([("x" * 22,), ("x" * 23,)], "t string")
    assert [r[0] for r in df.select(columns.short_label(F.col("t"))).collect()] == ["x" * 22, "x" * 22 + "..."]
    words = spark.createDataFrame([("  Fresh\t Produce",)], "t string")
    assert words.select(columns.first_word(F.col("t"))).first()[0] == "Fresh"


def test_slim_exports(spark):
    s = shop(
        spark, users=[user("u")], products=[product("p", "n")], sessions=[session(1, "u", referrer=None)],
        transactions=[transaction(1, "u", [("p", 1, 2.0)])],
    )
    assert flatten.slim_sessions(s.sessions).first().referrer == ""
    assert flatten.slim_users(s.users).columns[1:4] == ["city", "state", "country"]
    assert flatten.slim_products(s.products).first().base_price == 10.0
    assert flatten.slim_transactions(s.transactions).first().total == 2.0
