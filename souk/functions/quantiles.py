"""Exact percentile without collecting all values in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.columns import ratio

ACCURACY = 10_000


def exact_percentile(values: DataFrame, column: str, p: float) -> float | None:
    """The exact percentile ``p`` with linear interpolation, as ``percentile`` gives it.

    ``percentile`` merges a map of all distinct values in one task. Here an
    approximate sketch with a rank error of 1/ACCURACY first brackets the wanted
    ranks; only the few values in between are ordered. ``values`` is read
    several times, so pass a stored table.
    """
    values = values.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    n = values.count()
    if n == 0:
        return None
    position = p * (n - 1)
    lower = int(position)
    upper = min(lower + 1, n - 1)

    margin = 2 / ACCURACY + 2 / n
    low, high = values.agg(
        F.percentile_approx("v", max(0.0, p - margin), ACCURACY),
        F.percentile_approx("v", min(1.0, p + margin), ACCURACY),
    ).first()
    # All values below `low` are one null row, which sorts first. The other rows are
    # the distinct values of about 4/ACCURACY of the data.
    counted = (
        values.where(F.col("v") <= high)
        .groupBy(F.when(F.col("v") >= low, F.col("v")).alias("v"))
        .agg(F.count("*").alias("n"))
    )
    ranked = counted.withColumn("up_to", F.sum("n").over(Window.orderBy(F.asc_nulls_first("v"))))
    below, at_lower, at_upper = ranked.agg(
        F.max(F.when(F.col("v").isNull(), F.col("up_to"))),
        F.min(F.when(F.col("up_to") > lower, F.col("v"))),
        F.min(F.when(F.col("up_to") > upper, F.col("v"))),
    ).first()
    if (below or 0) > lower or at_upper is None:
        raise ArithmeticError("the sketch did not bracket the percentile")
    return at_lower + (position - lower) * (at_upper - at_lower)


def share_at_least(values: DataFrame, column: str, cut: float) -> DataFrame:
    """Rows and sum at or above ``cut`` against all rows, in one pass."""
    top: Column = F.col(column) >= F.lit(cut)
    amount = F.col(column).cast("decimal(18,2)")
    return values.agg(
        F.count(F.when(top, 1)).alias("top_rows"),
        F.count("*").alias("all_rows"),
        F.sum(F.when(top, amount)).alias("top_sum"),
        F.sum(amount).alias("all_sum"),
    ).withColumn("top_share", ratio(F.col("top_sum"), F.col("all_sum")))
