"""Revenue by product, category, month, payment method and province.

Lines are summed per product id before they meet the catalog: the join then has
one row per product, whatever the share of a best seller.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.columns import day_text, first_word, mean, money, month_text, paid, percent, ratio, short_label


def product_sums(lines: DataFrame) -> DataFrame:
    return lines.groupBy("product_id").agg(F.sum("subtotal").alias("revenue"), F.sum("quantity").alias("units"))


def top_products_lines(lines: DataFrame, enriched_products: DataFrame, n: int = 10) -> DataFrame:
    """Best products of completed orders, counting order lines.

    The limit comes before the join: ``n`` rows look up their names, and the lines are read once.
    """
    top = (
        lines.where(F.col("status") == "completed")
        .groupBy("product_id")
        .agg(F.sum("subtotal").alias("revenue"), F.sum("quantity").alias("units"), F.count("*").alias("order_count"))
        .orderBy(F.desc("revenue"), "product_id")
        .limit(n)
    )
    names = enriched_products.select(
        "product_id", F.col("name").alias("product_name"), F.col("category_name").alias("category")
    )
    return (
        top.join(names, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "category",
            money(F.col("revenue")).alias("total_revenue"),
            F.col("units").alias("total_units"),
            "order_count",
        )
        .orderBy(F.desc("total_revenue"), "product_id")
    )


def _paid_per_order(lines: DataFrame, order: str) -> DataFrame:
    """Paid lines summed per order and product, so that orders are counted without telling their ids apart again.

    Lines that a join has already placed by ``order`` are summed where they are.
    """
    return (
        paid(lines)
        .groupBy(order, "product_id")
        .agg(
            F.sum("subtotal").alias("revenue"),
            F.sum("quantity").alias("units"),
            F.sum("unit_price").alias("price_sum"),
            F.count("unit_price").alias("prices"),
        )
    )


def top_products_orders(lines: DataFrame, n: int = 10, order: str = "transaction_id") -> DataFrame:
    """Best products of paid orders, counting distinct orders by their key ``order``."""
    return (
        _paid_per_order(lines, order)
        .groupBy("product_id")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("units").alias("total_units"),
            F.count(order).alias("order_count"),
            F.sum("price_sum").alias("price_sum"),
            F.sum("prices").alias("prices"),
        )
        .orderBy(F.desc("revenue"), "product_id")
        .limit(n)
        .select(
            "product_id",
            money(F.col("revenue")).alias("total_revenue"),
            "total_units",
            "order_count",
            mean(F.col("price_sum"), F.col("prices")).alias("avg_price"),
        )
    )


def product_revenue(lines: DataFrame, order: str = "transaction_id") -> DataFrame:
    """All products of paid orders, best first; distinct orders are counted by their key ``order``."""
    return (
        _paid_per_order(lines, order)
        .groupBy("product_id")
        .agg(
            money(F.sum("revenue")).alias("total_revenue"),
            F.sum("units").alias("units_sold"),
            F.count(order).alias("orders"),
        )
        .orderBy(F.desc("total_revenue"), "product_id")
    )


def top_product_names(lines: DataFrame, products: DataFrame, n: int = 12) -> DataFrame:
    """Best product names; products that share a name count together."""
    return (
        product_sums(paid(lines))
        .join(products.select("product_id", "name"), "product_id", "left")
        .groupBy(F.coalesce("name", "product_id").alias("product_name"))
        .agg(F.sum("revenue").alias("revenue"), F.sum("units").alias("units"))
        .orderBy(F.desc("revenue"), "product_name")
        .limit(n)
        .select(
            "product_name",
            short_label(F.col("product_name")).alias("label"),
            money(F.col("revenue")).alias("revenue"),
            "units",
        )
    )


def daily_product_sales(lines: DataFrame) -> DataFrame:
    return (
        paid(lines)
        .groupBy("product_id", day_text(F.col("ts")).alias("day"))
        .agg(F.sum("quantity").alias("units_sold"), money(F.sum("subtotal")).alias("revenue"))
    )


# --- by month -------------------------------------------------------------------


def monthly_revenue_period(transactions: DataFrame) -> DataFrame:
    """Paid orders by year and month, labelled ``YYYY-MM``."""
    return (
        paid(transactions)
        .groupBy(F.year("ts").alias("year"), F.month("ts").alias("month"))
        .agg(F.sum("total").alias("revenue"), F.count("*").alias("order_count"), F.sum("discount").alias("discount"))
        .orderBy("year", "month")
        .select(
            F.concat_ws("-", "year", F.lpad(F.col("month").cast("string"), 2, "0")).alias("period"),
            money(F.col("revenue")).alias("total_revenue"),
            "order_count",
            mean(F.col("revenue"), F.col("order_count")).alias("avg_order_value"),
            money(F.col("discount")).alias("total_discount"),
        )
    )


def monthly_revenue(transactions: DataFrame) -> DataFrame:
    return (
        paid(transactions)
        .groupBy(month_text(F.col("ts")).alias("month"))
        .agg(
            F.count("*").alias("order_count"),
            F.sum("total").alias("revenue"),
            F.sum("discount").alias("discount"),
            F.sum("subtotal").alias("subtotal"),
        )
        .orderBy("month")
        .select(
            "month",
            "order_count",
            money(F.col("revenue")).alias("total_revenue"),
            mean(F.col("revenue"), F.col("order_count")).alias("avg_order_value"),
            money(F.col("discount")).alias("total_discounts"),
            percent(F.col("discount"), F.col("subtotal"), 1).alias("discount_rate_pct"),
        )
    )


def monthly_growth(transactions: DataFrame) -> DataFrame:
    """Revenue against the month before. The window sees one row per month."""
    previous = F.lag("total_revenue").over(Window.orderBy("month"))
    return (
        monthly_revenue(transactions)
        .select("month", "total_revenue", previous.alias("previous_revenue"))
        .withColumn(
            "mom_growth_pct", percent(F.col("total_revenue") - F.col("previous_revenue"), F.col("previous_revenue"))
        )
    )


# --- by category, payment method and province -------------------------------------


def category_revenue(lines: DataFrame, enriched_products: DataFrame) -> DataFrame:
    """Paid revenue by category; lines of unknown products are left out."""
    return (
        product_sums(paid(lines))
        .join(enriched_products.select("product_id", "category_name"), "product_id")
        .groupBy(F.col("category_name").alias("category"))
        .agg(
            money(F.sum("revenue")).alias("revenue"),
            F.sum("units").alias("units_sold"),
            F.count("*").alias("unique_products"),
        )
        .orderBy(F.desc("revenue"), "category")
    )


def category_revenue_top(lines: DataFrame, products: DataFrame, categories: DataFrame, n: int = 10) -> DataFrame:
    """Best categories by the first word of their name; unknown products count as Other."""
    category_of = products.select("product_id", "category_id").join(
        categories.select("category_id", first_word(F.col("category_name")).alias("category")), "category_id", "left"
    )
    return (
        product_sums(paid(lines))
        .join(category_of, "product_id", "left")
        .groupBy(F.coalesce("category", F.lit("Other")).alias("category"))
        .agg(F.sum("revenue").alias("total"), F.sum("units").alias("units"))
        .orderBy(F.desc("total"), "category")
        .limit(n)
        .select("category", money(F.col("total")).alias("revenue"), "units")
    )


def payment_mix(transactions: DataFrame) -> DataFrame:
    """Transactions and revenue by payment method, whatever their status."""
    return (
        transactions.groupBy("payment_method")
        .agg(F.count("*").alias("transaction_count"), money(F.sum("total")).alias("total_revenue"))
        .orderBy(F.desc("transaction_count"), "payment_method")
    )


def province_revenue(transactions: DataFrame, users: DataFrame) -> DataFrame:
    """Paid orders and revenue by the province of the buyer."""
    return (
        paid(transactions)
        .groupBy("user_id")
        .agg(F.sum("total").alias("spend"), F.count("*").alias("orders"))
        .join(users.select("user_id", F.col("state").alias("province")), "user_id")
        .groupBy("province")
        .agg(
            F.count("*").alias("buyers"), F.sum("orders").alias("orders"), money(F.sum("spend")).alias("total_revenue")
        )
        .orderBy(F.desc("total_revenue"), "province")
    )


def kpi_summary(transactions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Total revenue and average order over all statuses, and the session conversion rate."""
    orders = transactions.agg(F.sum("total").alias("revenue"), F.count("total").alias("orders"))
    visits = sessions.agg(
        F.count(F.when(F.col("conversion_status") == "converted", 1)).alias("converted"),
        F.count("*").alias("sessions"),
    )
    both = orders.unionByName(visits, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        money(F.col("revenue")).alias("total_revenue"),
        F.concat(F.lit("RWF "), F.format_number(F.round("revenue", 0), 0)).alias("total_revenue_label"),
        (F.coalesce(ratio(F.col("converted"), F.col("sessions")), F.lit(0.0)) * 100).alias("conversion_rate_pct"),
        mean(F.col("revenue"), F.col("orders")).alias("avg_order"),
    )
