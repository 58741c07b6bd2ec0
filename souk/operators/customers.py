"""Customer segments, cohorts and lifetime value.

Everything starts from one row per user (or user and month), summed on the map
side, so a user with very many orders or sessions costs one row in the joins.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.columns import (
    elapsed_days,
    iso_text,
    mean,
    money,
    month_text,
    months_between_calendar,
    paid,
    percent,
    ratio,
    round_double,
)
from souk.functions.quantiles import exact_percentile, share_at_least
from souk.session import materialize

# Fixed values of the lifetime value formula.
BASE_RETENTION, ENGAGEMENT_BONUS = 0.60, 0.30
TENURE_OF_UNKNOWN_USER, TENURE_OF_BAD_DATE = 3, 1
DAYS_PER_MONTH = 30


def order_sums(transactions: DataFrame) -> DataFrame:
    """Paid orders and spend per user."""
    return (
        paid(transactions)
        .groupBy("user_id")
        .agg(F.count("*").alias("order_count"), F.sum("total").alias("spend"))
    )


def user_order_stats(transactions: DataFrame) -> DataFrame:
    return order_sums(transactions).select(
        "user_id",
        "order_count",
        money(F.col("spend")).alias("total_spent"),
        mean(F.col("spend"), F.col("order_count")).alias("avg_order"),
    )


def purchase_sums(transactions: DataFrame, *parts: str) -> DataFrame:
    """Paid orders per user, and per value of the columns ``parts``, as sums that add up."""
    return (
        paid(transactions)
        .groupBy("user_id", *parts)
        .agg(F.count("*").alias("total_orders"), F.sum("total").alias("spend"), F.max("ts").alias("last_ts"))
    )


def summary_of_sums(sums: DataFrame) -> DataFrame:
    return sums.select(
        "user_id",
        "total_orders",
        money(F.col("spend")).alias("total_spent"),
        mean(F.col("spend"), F.col("total_orders")).alias("avg_order"),
        iso_text(F.col("last_ts")).alias("last_purchase"),
    )


def purchase_summary(transactions: DataFrame) -> DataFrame:
    """The summary that user profiles cache, over paid orders."""
    return summary_of_sums(purchase_sums(transactions))


def inactive_users(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """Users without a paid order."""
    buyers = paid(transactions).select("user_id").distinct()
    return users.join(buyers, "user_id", "left_anti").select("user_id")


# --- segments -------------------------------------------------------------------


def buyer_segments(transactions: DataFrame) -> DataFrame:
    """Buyers by number of paid orders."""
    n = F.col("order_count")
    segment = F.when(n >= 5, "High-Frequency").when(n >= 2, "Regular").when(n == 1, "One-Time").otherwise("Inactive")
    return (
        order_sums(transactions)
        .groupBy(segment.alias("segment"))
        .agg(F.count("*").alias("user_count"), F.sum("spend").alias("spend"), F.sum("order_count").alias("orders"))
        .select(
            "segment",
            "user_count",
            mean(F.col("spend"), F.col("user_count")).alias("avg_lifetime_spend"),
            mean(F.col("orders"), F.col("user_count"), 1).alias("avg_orders"),
        )
        .orderBy(F.desc("user_count"), "segment")
    )


def user_segments(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """All users by number of paid orders. Every segment is listed, also an empty one."""
    n = F.coalesce("order_count", F.lit(0))
    counts = (
        users.select("user_id")
        .distinct()
        .join(order_sums(transactions), "user_id", "left")
        .agg(
            *[
                F.struct(
                    F.count(F.when(inside, 1)).alias("users"),
                    F.coalesce(F.sum(F.when(inside, F.col("spend"))), F.lit(0)).alias("spend"),
                ).alias(label)
                for label, inside in (
                    ("High-Frequency (5+)", n >= 5),
                    ("Regular (2-4)", (n >= 2) & (n < 5)),
                    ("One-Time", n == 1),
                    ("Inactive", n == 0),
                )
            ],
            F.count("*").alias("everyone"),
        )
    )
    labels = [c for c in counts.columns if c != "everyone"]
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("segment"),
                F.col(f"`{label}`.users").alias("user_count"),
                F.col(f"`{label}`.spend").alias("spend"),
            )
            for label in labels
        ]
    )
    return counts.select("everyone", F.inline(rows)).select(
        "segment",
        "user_count",
        percent(F.col("user_count"), F.col("everyone"), 1).alias("share_pct"),
        F.coalesce(mean(F.col("spend"), F.col("user_count")), F.lit(0.0)).alias("avg_spend"),
    )


# --- cohorts --------------------------------------------------------------------


def cohort_spend(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """Paid spend by registration month and months since.

    Offsets may be negative. Users without a readable registration date are left
    out. One user has one cohort, so a (user, month) row is exactly one active user of a
    (cohort, offset) cell and no distinct count is needed.
    """
    monthly = (
        paid(transactions)
        .groupBy("user_id", F.trunc("ts", "month").alias("month"))
        .agg(F.count("*").alias("orders"), F.sum("total").alias("spend"))
    )
    registered = users.where(F.col("registered_at").isNotNull()).select("user_id", "registered_at")
    return (
        monthly.join(registered, "user_id")
        .groupBy(
            month_text(F.col("registered_at")).alias("cohort"),
            months_between_calendar(F.col("month"), F.col("registered_at")).alias("month_offset"),
        )
        .agg(F.count("*").alias("active_users"), F.sum("spend").alias("spend"), F.sum("orders").alias("orders"))
        .select(
            "cohort",
            "month_offset",
            "active_users",
            money(F.col("spend")).alias("total_spend"),
            "orders",
            mean(F.col("spend"), F.col("active_users")).alias("avg_spend"),
        )
        .orderBy("cohort", "month_offset")
    )


def cohort_pivot(cohorts: DataFrame, offsets: tuple[int, ...] = (0, 1, 2), n: int = 4) -> DataFrame:
    """Spend of the first ``n`` cohorts, one column per month offset."""
    return (
        cohorts.groupBy("cohort")
        .pivot("month_offset", list(offsets))
        .agg(F.sum("total_spend"))
        .select("cohort", *[F.col(str(k)).alias(f"month_{k}") for k in offsets])
        .na.fill(0.0)
        .orderBy("cohort")
        .limit(n)
    )


# --- lifetime value ----------------------------------------------------------------


def session_sums(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("user_id").agg(
        F.count("*").alias("sessions"),
        F.sum("duration_seconds").alias("duration"),
        F.count(F.when(F.col("conversion_status") == "converted", 1)).alias("converted"),
    )


def tenure_months(ref_date: str) -> Column:
    """Whole 30-day months since registration, at least 1.

    ``known`` tells a user with an unreadable date from one who is not in the table.
    """
    days = elapsed_days(F.col("registered_at"), F.lit(ref_date).cast("timestamp"))
    return (
        F.when(F.col("known").isNull(), TENURE_OF_UNKNOWN_USER)
        .when(F.col("registered_at").isNull(), TENURE_OF_BAD_DATE)
        .otherwise(F.greatest(F.lit(1), F.floor(days / DAYS_PER_MONTH)))
    )


def clv(
    users: DataFrame,
    transactions: DataFrame,
    sessions: DataFrame,
    ref_date: str = "2026-03-07",
    use_duration: bool = True,
    months: int = 6,
    high: float = 500.0,
    medium: float = 150.0,
) -> DataFrame:
    """Projected lifetime value of every buyer, from spend, tenure and engagement."""
    known = users.select("user_id", "registered_at", F.lit(True).alias("known"))
    visits = F.greatest(F.lit(1), F.coalesce("sessions", F.lit(0)))
    conversion = ratio(F.coalesce("converted", F.lit(0)), visits)
    duration = ratio(F.coalesce("duration", F.lit(0)), visits)
    engagement = conversion * 2 + duration / 3600 if use_duration else conversion * 2
    return (
        order_sums(transactions)
        .join(session_sums(sessions), "user_id", "left")
        .join(known, "user_id", "left")
        .withColumn("monthly", ratio(F.col("spend"), tenure_months(ref_date)))
        .withColumn("score", F.least(F.lit(1.0), engagement))
        .withColumn("retention", F.lit(BASE_RETENTION) + F.lit(ENGAGEMENT_BONUS) * F.col("score"))
        .withColumn("clv_estimate", round_double(F.col("monthly") * months * F.col("retention")))
        .select(
            "user_id",
            "clv_estimate",
            round_double(F.col("monthly")).alias("avg_monthly_revenue"),
            F.col("order_count").alias("total_orders"),
            money(F.col("spend")).alias("total_spend"),
            round_double(F.col("score"), 3).alias("engagement_score"),
            F.when(F.col("clv_estimate") > high, "High")
            .when(F.col("clv_estimate") > medium, "Medium")
            .otherwise("Low")
            .alias("clv_segment"),
        )
    )


def clv_ranked(estimates: DataFrame) -> DataFrame:
    return estimates.orderBy(F.desc("clv_estimate"), "user_id")


def clv_segments(estimates: DataFrame) -> DataFrame:
    value = F.col("clv_estimate")
    return (
        estimates.groupBy("clv_segment")
        .agg(F.count("*").alias("user_count"), F.sum(value.cast("decimal(18,2)")).alias("sum"), F.max(value).alias("max_clv"))
        .select("clv_segment", "user_count", mean(F.col("sum"), F.col("user_count")).alias("avg_clv"), "max_clv")
    )


def clv_top(estimates: DataFrame, n: int = 5) -> DataFrame:
    return clv_ranked(estimates).limit(n)


def clv_histogram(estimates: DataFrame, bins: int = 30) -> DataFrame:
    """Users per equal-width bin from smallest to largest value, empty bins included.

    The last bin is closed. With one single value the range is widened by half to either side.
    """
    values = materialize(estimates.select("clv_estimate"), "clv")
    low, high, total, n = values.agg(
        F.min("clv_estimate"), F.max("clv_estimate"), F.sum(F.col("clv_estimate").cast("decimal(18,2)")), F.count("*")
    ).first()
    all_bins = values.sparkSession.range(bins).select(F.col("id").alias("bin"))
    if n == 0:
        low, high, total = 0.0, 1.0, 0
    elif low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    position = F.floor((F.col("clv_estimate") - low) / width)
    counts = values.groupBy(F.least(position, F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("users"))
    return (
        all_bins.join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(low) + F.col("bin") * width).alias("lower_edge"),
            F.coalesce("users", F.lit(0)).alias("users"),
            mean(F.lit(total), F.lit(max(1, n))).alias("mean_clv"),
        )
        .orderBy("bin")
    )


def clv_concentration(estimates: DataFrame, top_share: float = 0.2) -> DataFrame:
    """The share of all value held by users at or above the exact percentile."""
    values = materialize(estimates.select("clv_estimate"), "clv")
    cut = exact_percentile(values, "clv_estimate", 1 - top_share)
    return share_at_least(values, "clv_estimate", cut).select(
        round_double(F.lit(cut)).alias("cut_clv"),
        F.col("top_rows").alias("top_users"),
        F.col("all_rows").alias("all_users"),
        F.col("top_share").alias("top_value_share"),
    )
