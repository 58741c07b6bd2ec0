"""Session boundaries in an event log, safe for users with very many events."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Time and event id as one number: its minimum is found by hash aggregation, without sorting the events.
ID_SPACE = "10000000000000000000BD"
IN_ORDER = f"CAST(CAST(unix_micros(ts) AS DECIMAL(18,0)) * {ID_SPACE} + CAST(event_id AS DECIMAL(19,0)) AS DECIMAL(38,0))"


def with_bucket(events: DataFrame, gap_seconds: int) -> DataFrame:
    """Add ``bucket``, the index of a time slice shorter than the gap.

    Two events of one user in one slice are never more than the gap apart, so a
    slice always lies in a single session.
    """
    width = gap_seconds * 1_000_000 // 6
    return events.withColumn("bucket", F.expr(f"unix_micros(ts) div {width}"))


def session_slices(events: DataFrame, gap_seconds: int, *measures: Column) -> DataFrame:
    """One row per user and slice with the id of the session it belongs to.

    ``events`` needs ``user_id, ts, event_id``. A session starts where the time
    since the user's previous event exceeds the gap; its id is the first event by
    (ts, event_id). The window runs over slices, not events: a user with any number
    of events has at most one row per slice of the covered time.
    """
    slices = (
        with_bucket(events, gap_seconds)
        .groupBy("user_id", "bucket")
        .agg(
            F.min("ts").alias("first_ts"),
            F.min(F.expr(IN_ORDER)).alias("first_in_order"),
            F.max("ts").alias("last_ts"),
            F.count("*").alias("event_count"),
            *measures,
        )
    )
    first = F.struct(F.col("first_ts").alias("ts"), F.expr(f"CAST(first_in_order % {ID_SPACE} AS BIGINT)").alias("event_id"))
    slices = slices.withColumn("first", first).drop("first_ts", "first_in_order")
    in_order = Window.partitionBy("user_id").orderBy("bucket")
    since_previous = F.unix_micros("first.ts") - F.unix_micros(F.lag("last_ts").over(in_order))
    starts = since_previous.isNull() | (since_previous > gap_seconds * 1_000_000)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    opening = F.last(F.when(F.col("starts"), F.col("first")), ignorenulls=True).over(so_far)
    return (
        slices.withColumn("starts", starts)
        .withColumn("opening", opening)
        .selectExpr("* EXCEPT (opening)", "opening.event_id AS first_event_id", "opening.ts AS started_at")
    )


def tag_events(events: DataFrame, gap_seconds: int) -> DataFrame:
    """The events with the ``first_event_id`` and the start of their session."""
    sessions = session_slices(events, gap_seconds).select("user_id", "bucket", "first_event_id", "started_at")
    return with_bucket(events, gap_seconds).join(sessions, ["user_id", "bucket"]).drop("bucket")
