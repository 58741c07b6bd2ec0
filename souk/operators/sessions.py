"""Conversion by device and referrer, session funnel, per-session lookups."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.columns import mean, money, paid, percent


def paid_per_session(transactions: DataFrame) -> DataFrame:
    """Paid orders and revenue per session id: one row per session before any join."""
    return (
        paid(transactions)
        .where(F.col("session_id").isNotNull() & (F.col("session_id") != ""))
        .groupBy("session_id")
        .agg(F.count("*").alias("orders"), F.sum("total").alias("revenue"))
    )


def converted_sessions(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Sessions with at least one paid order."""
    return sessions.join(paid_per_session(transactions), "session_id", "left_semi").select("session_id", "user_id")


def session_last_total(transactions: DataFrame) -> DataFrame:
    """The total of the last transaction of each session, any status."""
    return (
        transactions.where(F.col("session_id").isNotNull() & (F.col("session_id") != ""))
        .groupBy("session_id")
        .agg(money(F.max_by("total", F.struct("ts", "transaction_id"))).alias("last_total"))
    )


def device_conversion(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Sessions, transactions of any status and duration by device.

    The average duration is over the rows of sessions LEFT JOIN transactions, so a
    session counts once per transaction; it is computed from the number of
    transactions per session instead of multiplying the rows. The average per session
    is given besides.
    """
    per_session = transactions.groupBy("session_id").agg(F.count("*").alias("orders"))
    rows = F.greatest(F.lit(1), F.coalesce("orders", F.lit(0)))
    return (
        sessions.select("session_id", "device_type", "duration_seconds")
        .join(per_session, "session_id", "left")
        .groupBy("device_type")
        .agg(
            F.count("*").alias("sessions"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("conversions"),
            F.sum(F.when(F.col("duration_seconds").isNotNull(), rows)).alias("joined_rows"),
            F.sum(F.col("duration_seconds") * rows).alias("joined_seconds"),
            F.count("duration_seconds").alias("timed_sessions"),
            F.sum("duration_seconds").alias("seconds"),
        )
        .select(
            "device_type",
            "sessions",
            "conversions",
            mean(F.col("joined_seconds"), F.col("joined_rows") * 60, 1).alias("avg_min"),
            percent(F.col("conversions"), F.col("sessions")).alias("conv_pct"),
            mean(F.col("seconds"), F.col("timed_sessions") * 60, 1).alias("avg_min_per_session"),
        )
        .orderBy(F.desc("conv_pct"), "device_type")
    )


def device_conversion_sql(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """The same report under the column names of the SQL version."""
    return device_conversion(sessions, transactions).select(
        "device_type",
        F.col("sessions").alias("total_sessions"),
        "conversions",
        F.col("conv_pct").alias("conversion_rate_pct"),
        F.col("avg_min").alias("avg_session_min"),
    )


def device_totals(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Sessions and sessions with a paid order by device."""
    return (
        sessions.select("session_id", "device_type")
        .join(paid_per_session(transactions), "session_id", "left")
        .groupBy("device_type")
        .agg(F.count("*").alias("sessions"), F.count("orders").alias("converted_sessions"))
        .withColumn("conversion_rate_pct", percent(F.col("converted_sessions"), F.col("sessions")))
        .orderBy("device_type")
    )


def _by_referrer(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    return (
        sessions.select("session_id", "referrer")
        .join(paid_per_session(transactions), "session_id", "left")
        .groupBy("referrer")
        .agg(
            F.count("*").alias("sessions"),
            F.count("orders").alias("converted_sessions"),
            F.coalesce(F.sum("orders"), F.lit(0)).alias("conversions"),
            F.sum("revenue").alias("revenue"),
        )
    )


def referrer_revenue(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Sessions, paid orders and revenue by referrer; without revenue comes last."""
    return (
        _by_referrer(sessions, transactions)
        .select(
            "referrer",
            "sessions",
            "conversions",
            money(F.col("revenue")).alias("total_revenue"),
            mean(F.col("revenue"), F.col("conversions")).alias("avg_order_value"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), "referrer")
    )


def referrer_top(sessions: DataFrame, transactions: DataFrame, n: int = 6) -> DataFrame:
    """The busiest referrers with conversion rate and revenue of paid orders."""
    return (
        _by_referrer(sessions.na.fill("unknown", ["referrer"]), transactions)
        .orderBy(F.desc("sessions"), "referrer")
        .limit(n)
        .select(
            "referrer",
            "sessions",
            "converted_sessions",
            percent(F.col("converted_sessions"), F.col("sessions"), 1).alias("conversion_pct"),
            money(F.coalesce("revenue", F.lit(0))).alias("revenue"),
        )
    )


def session_funnel(sessions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Five stages from visit to paid order, with share of the first and loss from the previous.

    All session stages come from one aggregation; the window sees five rows.
    """
    stages = sessions.agg(
        F.count("*").alias("n1"),
        F.count(F.when(F.col("has_viewed_product"), 1)).alias("n2"),
        F.count(F.when(F.col("has_cart"), 1)).alias("n3"),
        F.count(F.when(F.col("conversion_status") == "converted", 1)).alias("n4"),
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).cast("bigint").alias("stage_no"), F.lit(name).alias("stage"), F.col(f"n{i}").alias("n"))
                    for i, name in enumerate(("All Sessions", "Viewed Product", "Added to Cart", "Converted"), 1)
                ]
            )
        )
    )
    last = paid(transactions).agg(
        F.lit(5).cast("bigint").alias("stage_no"), F.lit("Completed Order").alias("stage"), F.count("*").alias("n")
    )
    in_order = Window.orderBy("stage_no")
    previous = F.lag("n").over(in_order)
    first = F.first("n").over(in_order)
    return stages.unionByName(last).select(
        "stage_no",
        "stage",
        "n",
        percent(F.col("n"), first).alias("pct_of_first"),
        percent(previous - F.col("n"), previous).alias("drop_pct"),
    )
