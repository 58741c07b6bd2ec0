"""All reports by name, each over the whole tables of a shop."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.functions.columns import iso_text, paid
from souk.operators import baskets, customers, flatten, keyed, products, quality, revenue, sessions
from souk.plans.incremental import TIME, StoredFigures
from souk.session import fresh_dir, materialize
from souk.sources.warehouse import PAYMENT_METHOD, SESSION_GAP_SECONDS, Warehouse, key
from souk.streaming import jobs

Report = Callable[[Warehouse], DataFrame]
REPORTS: dict[str, Report] = {}

# Parameters that fit the span and the amounts of the order tables.
CLV = {"ref_date": "2002-01-01", "high": 60_000.0, "medium": 30_000.0}


def report(build: Report) -> Report:
    REPORTS[build.__name__] = build
    return build


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Report) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(Warehouse(spark, folder))

    return {name: bind(build) for name, build in REPORTS.items()}


# --- keyed access -----------------------------------------------------------------


def busiest_user(shop) -> str:
    """The user to look up; a user to start with, as there are no users without events."""
    row = keyed.busiest_user(shop.sessions).first()
    return row["user_id"] if row else "user_000000000"


@report
def user_sessions_recent(shop):
    user = busiest_user(shop)
    return keyed.user_sessions(keyed.session_keyed_table(shop.of_user(user).session_cells), user)


@report
def user_sessions_converted(shop):
    user = busiest_user(shop)
    return keyed.user_converted_sessions(keyed.session_keyed_table(shop.of_user(user).session_cells), user)


@report
def recent_sessions_per_user(shop):
    return keyed.recent_sessions_per_user(shop.sessions)


@report
def session_keyed_table(shop):
    return keyed.session_keyed_table(shop.session_cells)


@report
def keep_last_3_versions(shop):
    return keyed.keep_last_versions(shop.cell_versions)


@report
def session_last_total(shop):
    return sessions.session_last_total(shop.transactions)


# --- quality ----------------------------------------------------------------------


@report
def entity_counts(shop):
    return quality.row_counts(
        users=shop.users,
        categories=shop.categories,
        products=shop.products,
        sessions=shop.sessions,
        transactions=shop.transactions,
    )


@report
def clean_transactions(shop):
    return quality.clean_transactions(shop.raw_transactions).select(
        "transaction_id",
        "user_id",
        "status",
        iso_text(F.col("ts")).alias("timestamp"),
        *[F.col(c).cast("double").alias(c) for c in ("subtotal", "discount", "total")],
        "discount_pct",
    )


@report
def clean_transactions_report(shop):
    return quality.transaction_report(shop.raw_transactions)


@report
def clean_sessions(shop):
    return quality.clean_sessions(shop.raw_sessions)


@report
def clean_sessions_report(shop):
    return quality.session_report(shop.raw_sessions)


@report
def duplicate_keys(shop):
    return quality.union_all(
        [
            quality.duplicates(shop.users, "users", "user_id"),
            quality.duplicates(shop.products, "products", "product_id"),
            quality.duplicates(shop.transactions, "transactions", "transaction_id"),
            quality.duplicates(shop.sessions, "sessions", "session_id"),
            quality.duplicates(shop.table("lineitem"), "order_lines", "l_orderkey", "l_linenumber"),
        ]
    )


@report
def fk_violations(shop):
    tables = {
        "users": shop.users,
        "transactions": shop.transactions,
        "sessions": shop.sessions,
        "products": shop.products,
        "categories": flatten.export_categories(shop.categories, shop.subcategories),
        "orders": shop.table("orders"),
        "items": shop.table("lineitem"),
        "parts": shop.table("part"),
    }
    return quality.reference_faults(
        tables,
        [
            quality.Relation("users-transactions", "users", "user_id", "transactions", "user_id"),
            quality.Relation("users-sessions", "users", "user_id", "sessions", "user_id"),
            quality.Relation("transactions-items", "orders", "o_orderkey", "items", "l_orderkey"),
            quality.Relation("products-items", "parts", "p_partkey", "items", "l_partkey"),
            quality.Relation("categories-products", "categories", "category_id", "products", "category_id"),
            quality.Relation("sessions-transactions", "sessions", "session_id", "transactions", "session_id"),
        ],
    )


# --- flatten and enrich --------------------------------------------------------------


@report
def export_users(shop):
    return flatten.export_users(shop.users, customers.purchase_summary(shop.transactions))


@report
def export_products(shop):
    return flatten.export_products(shop.products, shop.categories, shop.subcategories)


@report
def export_transactions(shop):
    return flatten.export_transactions(shop.transactions)


@report
def export_transaction_items(shop):
    return flatten.export_transaction_items(shop.lines, shop.products)


@report
def export_sessions(shop):
    return flatten.export_sessions(shop.session_cells)


@report
def export_categories(shop):
    return flatten.export_categories(shop.categories, shop.subcategories)


@report
def slim_transactions(shop):
    return flatten.slim_transactions(shop.transactions)


@report
def slim_users(shop):
    return flatten.slim_users(shop.users)


@report
def slim_products(shop):
    return flatten.slim_products(shop.products)


@report
def slim_sessions(shop):
    return flatten.slim_sessions(shop.sessions)


@report
def enrich_products(shop):
    enriched = flatten.enrich_products(shop.products, shop.categories, shop.subcategories)
    return flatten.slim_products(enriched, "category_name", "subcategory_name")


@report
def province_lookup(shop):
    return flatten.with_province(shop.users.select("user_id", "city"), shop.districts)


@report
def orders_from_carts(shop):
    return flatten.orders_from_carts(shop.cart).select(
        "session_id",
        "user_id",
        iso_text(F.col("ts")).alias("timestamp"),
        "line_count",
        *[F.col(c).cast("double").alias(c) for c in ("subtotal", "discount", "total")],
    )


@report
def order_lines_from_carts(shop):
    return flatten.order_lines_from_carts(shop.cart).select(
        "session_id",
        "product_id",
        "quantity",
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("subtotal").cast("double").alias("subtotal"),
    )


# --- filters and joins ----------------------------------------------------------------


@report
def paid_transactions(shop):
    return paid(shop.transactions).select(
        "transaction_id", "user_id", "status", F.col("total").cast("double").alias("total")
    )


@report
def converted_sessions_semi(shop):
    return sessions.converted_sessions(shop.sessions, shop.transactions)


@report
def inactive_users(shop):
    return customers.inactive_users(shop.users, shop.transactions)


# --- revenue --------------------------------------------------------------------------


@report
def top_products_lines(shop):
    return revenue.top_products_lines(shop.lines, flatten.with_category(shop.products, shop.categories))


@report
def top_products_orders(shop):
    return revenue.top_products_orders(shop.lines, order="o_orderkey")


@report
def product_revenue(shop):
    return revenue.product_revenue(shop.lines, order="o_orderkey")


@report
def top_product_names(shop):
    return revenue.top_product_names(shop.lines, shop.products)


@report
def monthly_revenue_period(shop):
    return revenue.monthly_revenue_period(shop.transactions)


@report
def monthly_revenue(shop):
    return revenue.monthly_revenue(shop.transactions)


@report
def monthly_growth(shop):
    return revenue.monthly_growth(shop.transactions)


@report
def daily_product_sales(shop):
    return revenue.daily_product_sales(shop.lines)


@report
def category_revenue(shop):
    return revenue.category_revenue(shop.lines, flatten.with_category(shop.products, shop.categories))


@report
def category_revenue_top10(shop):
    return revenue.category_revenue_top(shop.lines, shop.products, shop.categories)


@report
def payment_mix(shop):
    return revenue.payment_mix(shop.transactions)


@report
def province_revenue(shop):
    return revenue.province_revenue(shop.transactions, shop.users)


@report
def kpi_summary(shop):
    return revenue.kpi_summary(shop.transactions, shop.sessions)


# --- customers ------------------------------------------------------------------------


@report
def user_order_stats(shop):
    return customers.user_order_stats(shop.transactions)


@report
def buyer_segments(shop):
    return customers.buyer_segments(shop.transactions)


@report
def user_segments(shop):
    return customers.user_segments(shop.users, shop.transactions)


@report
def cohort_spend(shop):
    return customers.cohort_spend(shop.users, shop.transactions)


@report
def cohort_pivot(shop):
    return customers.cohort_pivot(customers.cohort_spend(shop.users, shop.transactions), offsets=(3, 4, 5))


def estimates(shop, **changes):
    return customers.clv(shop.users, shop.transactions, shop.sessions, **(CLV | changes))


@report
def clv(shop):
    return customers.clv_ranked(estimates(shop))


@report
def clv_no_duration(shop):
    return customers.clv_ranked(estimates(shop, use_duration=False))


@report
def clv_segments(shop):
    return customers.clv_segments(estimates(shop))


@report
def clv_top5(shop):
    return customers.clv_top(estimates(shop))


@report
def clv_histogram(shop):
    return customers.clv_histogram(estimates(shop, use_duration=False))


@report
def clv_concentration(shop):
    return customers.clv_concentration(estimates(shop))


@report
def purchase_summary(shop):
    return customers.purchase_summary(shop.transactions)


# --- sessions ---------------------------------------------------------------------------


@report
def sessionize_events(shop):
    return shop.sessions.select(
        "session_id", "user_id", "start_time", "end_time", "duration_seconds", F.col("page_view_count").alias("events")
    )


@report
def device_conversion_sql(shop):
    return sessions.device_conversion_sql(shop.sessions, shop.transactions)


@report
def device_conversion(shop):
    return sessions.device_conversion(shop.sessions, shop.transactions)


@report
def device_totals(shop):
    return sessions.device_totals(shop.sessions, shop.transactions)


@report
def referrer_revenue(shop):
    return sessions.referrer_revenue(shop.sessions, shop.transactions)


@report
def referrer_top6(shop):
    return sessions.referrer_top(shop.sessions, shop.transactions)


@report
def session_funnel(shop):
    return sessions.session_funnel(shop.sessions, shop.transactions)


# --- products ----------------------------------------------------------------------------


@report
def product_funnel(shop):
    return products.product_funnel(shop.pages("product_detail"), shop.cart_adds, shop.lines)


@report
def product_views(shop):
    return products.product_views(shop.pages("product_detail"))


@report
def product_cart_adds(shop):
    return products.product_cart_adds(shop.cart_adds)


@report
def product_purchases(shop):
    return products.product_purchases(shop.lines)


@report
def product_performance(shop):
    return products.product_performance(shop.pages("product_detail"), shop.cart_days, shop.lines)


#: The columns of order lines that daily figures are made from.
LINE_COLUMNS = ("product_id", "ts", "status", "quantity", "subtotal")


def in_two_batches(shop, **inputs: DataFrame) -> StoredFigures:
    """Figures by month over the whole inputs: first what is dated up to the 20th of a month, but for a tenth that comes late, then the rest.

    An input is computed once and written with the batch of each row; both batches read it there.
    """
    store = StoredFigures(shop.spark, fresh_dir(shop.spark, "figures"), {name: df.schema for name, df in inputs.items()}, "month")
    flagged = {}
    for name, df in inputs.items():
        on_time = (F.dayofmonth(TIME[name]) <= 20) & (F.pmod(F.xxhash64(*sorted(df.columns)), F.lit(10)) > 0)
        flagged[name] = materialize(df.select("*", F.coalesce(on_time, F.lit(False)).alias("_on_time")), f"batches-{name}")
    for batch, first in enumerate((True, False)):
        store.add(batch, **{name: df.where(F.col("_on_time") == first).drop("_on_time") for name, df in flagged.items()})
    return store


@report
def product_performance_by_batches(shop):
    inputs = {"page_views": shop.pages("product_detail"), "cart": shop.cart_days, "lines": shop.lines.select(*LINE_COLUMNS)}
    return in_two_batches(shop, **inputs).product_performance()


@report
def purchase_summary_by_batches(shop):
    return in_two_batches(shop, transactions=shop.transactions).purchase_summary()


@report
def copurchase_pairs(shop):
    return baskets.top_pairs(baskets.purchase_baskets(shop.lines))


@report
def also_bought(shop):
    return baskets.best_partners(baskets.purchase_baskets(shop.lines))


@report
def coview_pairs(shop):
    return baskets.top_pairs(baskets.view_baskets(shop.viewed))


# --- streams -----------------------------------------------------------------------------


def event_stream(shop, *more):
    return jobs.file_stream(
        shop.spark,
        shop.path("events"),
        "event_id",
        "timestamp(ts) AS ts",
        f"{key('user', 'user_id', 9)} AS user_id",
        "event_type",
        *more,
    )


@report
def stream_product_views(shop):
    views = event_stream(
        shop,
        "floor(value) AS view_duration",
        f"{key('prod', "get_json_object(props, '$.k')", 9)} AS product_id",
    ).where("event_type = 'view' AND product_id IS NOT NULL")
    stored, _ = jobs.run_update(jobs.views_per_user(views), ["product_id", "user_id"], "views")
    return jobs.view_counters(stored)


@report
def stream_payment_windows(shop):

    payments = jobs.file_stream(
        shop.spark,
        shop.path("orders"),
        "timestamp(o_orderdate) AS ts",
        f"{PAYMENT_METHOD} AS payment_method",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS total",
    )
    daily, _ = jobs.run_update(jobs.daily_payments(payments), ["payment_method"], "payments", folders="yyyy")
    return jobs.windows_of_days(daily, 1, "tumbling").unionByName(jobs.windows_of_days(daily, 7, "sliding"))


@report
def stream_sessions(shop):
    slices, _ = jobs.run_update(jobs.activity(event_stream(shop), SESSION_GAP_SECONDS), ["user_id"], "sessions")
    return jobs.sessions_of_activity(slices, SESSION_GAP_SECONDS)


@report
def stream_latest_session(shop):
    latest = jobs.run_upsert(event_stream(shop), "user_id", ["ts", "event_id"], "latest")
    return latest.select("user_id", "event_id", iso_text(F.col("ts")).alias("last_seen"), "event_type")


@report
def stream_dedup(shop):
    twice = event_stream(shop).unionByName(event_stream(shop))
    once = jobs.run_append(jobs.deduplicated(twice), "dedup")
    return once.select("event_id", "user_id", "event_type", iso_text(F.col("ts")).alias("timestamp"))
