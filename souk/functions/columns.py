"""Column expressions shared by the reports. All are built-in Spark functions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.schemas import PAID_STATUSES

MONEY = "decimal(18,2)"
ISO = "yyyy-MM-dd'T'HH:mm:ss"
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def is_paid(status: str = "status") -> Column:
    return F.col(status).isin(*PAID_STATUSES)


def paid(df: DataFrame) -> DataFrame:
    """Rows whose transaction is completed or shipped."""
    return df.where(is_paid())


def money(amount: Column, scale: int = 2) -> Column:
    """An exact DECIMAL amount as a DOUBLE for a report, rounded half up."""
    return F.round(amount, scale).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` in doubles; null when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def exact_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` of counts or amounts to 14 decimals; null when ``whole`` is 0."""
    return F.try_divide(part.cast("decimal(24,4)"), whole.cast("decimal(24,4)"))


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    return F.round(exact_ratio(part.cast("decimal(24,4)") * 100, whole), scale).cast("double")


def mean(total: Column, count: Column, scale: int = 2) -> Column:
    return F.round(exact_ratio(total, count), scale).cast("double")


def round_double(value: Column, scale: int = 2) -> Column:
    """Round a double half up by its first ten decimals, which drops binary noise at ties."""
    return F.round(value.cast("decimal(38,10)"), scale).cast("double")


def strip(text: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to TIMESTAMP; null for anything else."""
    return F.when(text.rlike(ISO_PATTERN), F.try_to_timestamp(text))


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO)


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def months_between_calendar(later: Column, earlier: Column) -> Column:
    """Difference of calendar months; negative when ``later`` comes first."""
    return ((F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))).cast("bigint")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour periods between two timestamps."""
    return F.timestamp_diff("DAY", start, end)


def first_word(text: Column) -> Column:
    return F.split(strip(text), r"\s+")[0]


def short_label(text: Column, width: int = 22) -> Column:
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)


def session_key(user_id: Column, started_at: Column) -> Column:
    """``user#reversed millis``: text order is newest first within a user.

    An unreadable start counts as now. The reversed value has 19 digits for
    every date after 1970, so text order equals numeric order.
    """
    millis = F.unix_millis(F.coalesce(started_at, F.current_timestamp()))
    return F.concat_ws("#", user_id, (F.lit(2**63 - 1) - millis).cast("string"))


def product_day_key(product_id: Column, day: Column) -> Column:
    return F.concat_ws("#", product_id, day)
