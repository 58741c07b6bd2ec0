"""Enrichment, star-schema exports and slim exports."""

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.columns import day_text, mean
from souk.schemas import PROVINCE_DISTRICTS


def or_default(name: str, value) -> Column:
    return F.coalesce(F.col(name), F.lit(value))


def province_of(city: Column) -> Column:
    """The province of a district; null for an unknown one."""
    pairs = [(city_name, province) for province, cities in PROVINCE_DISTRICTS.items() for city_name in cities]
    return F.try_element_at(F.create_map(*map(F.lit, chain.from_iterable(pairs))), city)


def with_province(users: DataFrame, districts: DataFrame) -> DataFrame:
    """Look up the province by city in a ``city, province`` table."""
    return users.join(districts.select("city", "province"), "city", "left")


def with_category(products: DataFrame, categories: DataFrame) -> DataFrame:
    return products.join(categories, "category_id", "left").na.fill("Unknown", ["category_name"])


def enrich_products(products: DataFrame, categories: DataFrame, subcategories: DataFrame) -> DataFrame:
    """Add the category name, and the subcategory name within that category."""
    names = subcategories.select("category_id", "subcategory_id", "subcategory_name")
    return (
        with_category(products, categories)
        .join(names, ["category_id", "subcategory_id"], "left")
        .na.fill("Unknown", ["subcategory_name"])
    )


# --- star schema --------------------------------------------------------------


def export_users(users: DataFrame, summary: DataFrame) -> DataFrame:
    """``summary`` is the purchase summary per user; users without one get zeros."""
    return users.join(summary, "user_id", "left").select(
        "user_id",
        or_default("city", "").alias("city"),
        or_default("state", "").alias("province"),
        or_default("country", "RW").alias("country"),
        or_default("registration_date", "").alias("registration_date"),
        or_default("last_active", "").alias("last_active"),
        or_default("total_orders", 0).alias("total_orders"),
        or_default("total_spent", 0.0).alias("total_spent_rwf"),
        or_default("avg_order", 0.0).alias("avg_order_rwf"),
    )


def export_products(products: DataFrame, categories: DataFrame, subcategories: DataFrame) -> DataFrame:
    # Subcategory ids are looked up on their own here, whatever their category.
    names = subcategories.groupBy("subcategory_id").agg(F.max("subcategory_name").alias("subcategory_name"))
    return (
        products.join(categories, "category_id", "left")
        .join(names, "subcategory_id", "left")
        .select(
            "product_id",
            or_default("name", "").alias("name"),
            "category_id",
            or_default("category_name", "").alias("category_name"),
            "subcategory_id",
            or_default("subcategory_name", "").alias("subcategory_name"),
            F.coalesce("base_price", F.lit(0)).cast("double").alias("base_price_rwf"),
            or_default("current_stock", 0).cast("bigint").alias("current_stock"),
            or_default("is_active", True).alias("is_active"),
            or_default("creation_date", "").alias("creation_date"),
        )
    )


def date_parts() -> dict[str, Column]:
    """Calendar columns of ``ts``. Unreadable text keeps its first 10 characters as date."""
    ts = F.col("ts")
    return {
        "date": F.coalesce(day_text(ts), F.substring("timestamp", 1, 10)),
        "year": F.year(ts).cast("bigint"),
        "month": F.month(ts).cast("bigint"),
        "month_name": F.date_format(ts, "MMMM"),
    }


def export_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.withColumns(date_parts()).select(
        "transaction_id",
        "user_id",
        "session_id",
        "timestamp",
        "date",
        "year",
        "month",
        "month_name",
        *[or_default(c, 0).cast("double").alias(f"{c}_rwf") for c in ("subtotal", "discount", "total")],
        "payment_method",
        "status",
        "item_count",
    )


def export_transaction_items(lines: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order line; a product missing from the catalog shows its id as name."""
    names = products.select("product_id", F.col("name").alias("product_name"))
    return (
        lines.withColumns(date_parts())
        .join(names, "product_id", "left")
        .select(
            "transaction_id",
            "user_id",
            "timestamp",
            "date",
            "month",
            "month_name",
            "status",
            "payment_method",
            "product_id",
            F.coalesce("product_name", "product_id").alias("product_name"),
            or_default("quantity", 0).alias("quantity"),
            or_default("unit_price", 0).cast("double").alias("unit_price_rwf"),
            or_default("subtotal", 0).cast("double").alias("item_subtotal_rwf"),
        )
    )


def export_sessions(cells: DataFrame) -> DataFrame:
    duration = or_default("duration_seconds", 0)
    return cells.select(
        "session_id",
        "user_id",
        "start_time",
        "end_time",
        duration.alias("duration_seconds"),
        mean(duration, F.lit(60)).alias("duration_minutes"),
        or_default("city", "").alias("city"),
        or_default("state", "").alias("province"),
        or_default("device_type", "").alias("device_type"),
        or_default("os", "").alias("os"),
        or_default("browser", "").alias("browser"),
        or_default("conversion_status", "").alias("conversion_status"),
        or_default("referrer", "").alias("referrer"),
        "page_view_count",
        F.col("cart_size").alias("cart_item_count"),
    )


def export_categories(categories: DataFrame, subcategories: DataFrame) -> DataFrame:
    """One row per subcategory."""
    return categories.join(subcategories, "category_id").select(
        "category_id",
        "category_name",
        "subcategory_id",
        "subcategory_name",
        or_default("profit_margin", 0.0).alias("profit_margin"),
    )


# --- slim exports ---------------------------------------------------------------


def slim_transactions(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        "transaction_id",
        "user_id",
        "timestamp",
        *[F.col(c).cast("double").alias(c) for c in ("total", "subtotal", "discount")],
        "status",
        "payment_method",
    )


def slim_users(users: DataFrame) -> DataFrame:
    return users.select("user_id", "city", "state", "country", "registration_date", "last_active")


def slim_products(products: DataFrame, *more: str) -> DataFrame:
    return products.select(
        "product_id",
        "name",
        "category_id",
        "subcategory_id",
        F.col("base_price").cast("double").alias("base_price"),
        F.col("current_stock").cast("bigint").alias("current_stock"),
        "is_active",
        *more,
    )


def slim_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "session_id",
        "user_id",
        "start_time",
        "duration_seconds",
        "device_type",
        "os",
        or_default("referrer", "").alias("referrer"),
        or_default("conversion_status", "").alias("conversion_status"),
    )


# --- carts to orders --------------------------------------------------------------


def order_lines_from_carts(cart: DataFrame) -> DataFrame:
    """The order lines of converted sessions; sessions with an empty cart have none."""
    return cart.where(F.col("conversion_status") == "converted").select(
        "session_id",
        "user_id",
        F.col("ended_at").alias("ts"),
        "product_id",
        "quantity",
        F.col("price").alias("unit_price"),
        F.round(F.col("quantity") * F.col("price"), 2).alias("subtotal"),
    )


def orders_from_carts(cart: DataFrame, discount_rate: float = 0.0) -> DataFrame:
    """One order per converted session with a cart, priced from its lines."""
    rate = F.lit(discount_rate).cast("decimal(6,4)")
    return (
        order_lines_from_carts(cart)
        .groupBy("session_id", "user_id", "ts")
        .agg(F.count("*").alias("line_count"), F.sum("subtotal").alias("subtotal"))
        .withColumn("discount", F.round(F.col("subtotal") * rate, 2))
        .withColumn("total", F.col("subtotal") - F.col("discount"))
    )
