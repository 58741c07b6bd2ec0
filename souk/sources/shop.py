"""The flat tables that all reports read, and how nested documents become flat.

Arrays and maps are opened once here by ``explode``, without a shuffle. Reports
then group and join plain rows, so no report ever gathers a basket, an order or
a session into one array.

=============== ==================================================================
users           user_id, city, state, country, registration_date, last_active (text),
                registered_at; optionally total_orders, total_spent, avg_order
categories      category_id, category_name
subcategories   category_id, subcategory_id, subcategory_name, profit_margin
products        product_id, name, category_id, subcategory_id, base_price,
                current_stock, is_active, creation_date
transactions    transaction_id, session_id, user_id, timestamp (text), ts, subtotal,
                discount, total (DECIMAL), payment_method, status, item_count
lines           transaction_id, user_id, timestamp, ts, payment_method, status,
                product_id, quantity, unit_price, subtotal (DECIMAL)
sessions        session_id, user_id, start_time, end_time (text), started_at, ended_at,
                duration_seconds, city, state, device_type, os, browser, referrer,
                conversion_status, page_view_count, has_viewed_product, has_cart
session_cells   sessions + viewed_products (comma-joined text), cart_size
page_views      user_id, ts, page_type, product_id, view_duration
viewed          session_id, product_id
cart_quantities session_id, product_id, quantity
cart            cart_quantities + user_id, started_at, ended_at, conversion_status,
                price (DECIMAL)
=============== ==================================================================

``transaction_id`` and ``session_id`` are unique keys of their tables; the
``duplicate_keys`` report checks that.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.columns import MONEY, parse_iso


@dataclass(frozen=True)
class Shop:
    users: DataFrame
    categories: DataFrame
    subcategories: DataFrame
    products: DataFrame
    transactions: DataFrame
    lines: DataFrame
    sessions: DataFrame
    session_cells: DataFrame
    page_views: DataFrame
    viewed: DataFrame
    cart_quantities: DataFrame
    cart: DataFrame


def event_time(documents: DataFrame) -> Column:
    """The cleaned time if there is one, else what the text says."""
    return F.col("ts") if "ts" in documents.columns else parse_iso(F.col("timestamp")).alias("ts")


def flat_users(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id",
        "geo_data.city",
        "geo_data.state",
        "geo_data.country",
        "registration_date",
        "last_active",
        parse_iso(F.col("registration_date")).alias("registered_at"),
        "purchase_summary.total_orders",
        "purchase_summary.total_spent",
        "purchase_summary.avg_order",
    )


def flat_categories(categories: DataFrame) -> DataFrame:
    return categories.select("category_id", F.col("name").alias("category_name"))


def flat_subcategories(categories: DataFrame) -> DataFrame:
    return categories.select("category_id", F.explode("subcategories").alias("s")).select(
        "category_id", "s.subcategory_id", F.col("s.name").alias("subcategory_name"), "s.profit_margin"
    )


def flat_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        "transaction_id",
        "session_id",
        "user_id",
        "timestamp",
        event_time(transactions),
        F.col("subtotal").cast(MONEY),
        F.col("discount").cast(MONEY),
        F.col("total").cast(MONEY),
        "payment_method",
        "status",
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("item_count"),
    )


def flat_lines(transactions: DataFrame) -> DataFrame:
    """One row per order line; an order without lines gives none."""
    return transactions.select(
        "transaction_id",
        "user_id",
        "timestamp",
        event_time(transactions),
        "payment_method",
        "status",
        F.explode("items").alias("i"),
    ).select(
        "transaction_id",
        "user_id",
        "timestamp",
        "ts",
        "payment_method",
        "status",
        "i.product_id",
        F.col("i.quantity").cast("bigint").alias("quantity"),
        F.col("i.unit_price").cast(MONEY).alias("unit_price"),
        F.col("i.subtotal").cast(MONEY).alias("subtotal"),
    )


def flat_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions with nested fields promoted and lists reduced to what reports need."""
    viewed_count = F.coalesce(F.size("viewed_products"), F.lit(0))
    cart_size = F.coalesce(F.size("cart_contents"), F.lit(0)).cast("bigint")
    return sessions.select(
        "session_id",
        "user_id",
        "start_time",
        "end_time",
        parse_iso(F.col("start_time")).alias("started_at"),
        parse_iso(F.col("end_time")).alias("ended_at"),
        F.col("duration_seconds").cast("bigint").alias("duration_seconds"),
        "geo_data.city",
        "geo_data.state",
        F.col("device_profile.type").alias("device_type"),
        "device_profile.os",
        "device_profile.browser",
        "referrer",
        "conversion_status",
        F.coalesce(F.size("page_views"), F.lit(0)).cast("bigint").alias("page_view_count"),
        (viewed_count > 0).alias("has_viewed_product"),
        (cart_size > 0).alias("has_cart"),
        F.concat_ws(",", "viewed_products").alias("viewed_products"),
        cart_size.alias("cart_size"),
    )


def flat_page_views(sessions: DataFrame) -> DataFrame:
    return sessions.select("user_id", F.explode("page_views").alias("v")).select(
        "user_id",
        parse_iso(F.col("v.timestamp")).alias("ts"),
        "v.page_type",
        "v.product_id",
        F.col("v.view_duration").cast("bigint").alias("view_duration"),
    )


def flat_viewed(sessions: DataFrame) -> DataFrame:
    return sessions.select("session_id", F.explode("viewed_products").alias("product_id"))


def flat_cart(sessions: DataFrame) -> DataFrame:
    """One row per product in a cart; the product id is the key of the map."""
    return sessions.select(
        "session_id",
        "user_id",
        parse_iso(F.col("start_time")).alias("started_at"),
        parse_iso(F.col("end_time")).alias("ended_at"),
        "conversion_status",
        F.explode("cart_contents").alias("product_id", "c"),
    ).select(
        "session_id",
        "user_id",
        "started_at",
        "ended_at",
        "conversion_status",
        "product_id",
        F.col("c.quantity").cast("bigint").alias("quantity"),
        F.col("c.price").cast(MONEY).alias("price"),
    )


def from_documents(
    users: DataFrame, categories: DataFrame, products: DataFrame, sessions: DataFrame, transactions: DataFrame
) -> Shop:
    """The flat tables of nested entity documents."""
    wide = flat_sessions(sessions)
    cart = flat_cart(sessions)
    return Shop(
        users=flat_users(users),
        categories=flat_categories(categories),
        subcategories=flat_subcategories(categories),
        products=products.drop("price_history").withColumn("base_price", F.col("base_price").cast(MONEY)),
        transactions=flat_transactions(transactions),
        lines=flat_lines(transactions),
        sessions=wide.drop("viewed_products", "cart_size"),
        session_cells=wide,
        page_views=flat_page_views(sessions),
        viewed=flat_viewed(sessions),
        cart_quantities=cart.select("session_id", "product_id", "quantity"),
        cart=cart,
    )
