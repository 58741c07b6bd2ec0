"""Structured Streaming versions of the counters and monitors.

Every job takes a streaming DataFrame, so the source can be files, Kafka or anything
else. State is bounded by a watermark. Jobs write to Parquet with a checkpoint in
the shared folder; nothing passes through the driver.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from souk.functions.columns import iso_text, mean, money
from souk.session import fresh_dir
from souk.sinks.upserts import KeyedTable, hashed


def views_per_user(views: DataFrame, delay: str = "1 day") -> DataFrame:
    """Views and seconds per product, day and user; ``views`` needs ``ts, product_id, user_id, view_duration``."""
    return (
        views.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 day"), "product_id", "user_id")
        .agg(
            F.count("*").alias("views"),
            F.sum("view_duration").alias("seconds"),
            F.count("view_duration").alias("timed_views"),
        )
    )


def view_counters(per_user: DataFrame) -> DataFrame:
    """Views, distinct users and average duration per product and day, from the figures per user.

    Users are counted exactly: each has one row per product and day. Runs on a stream in append mode, behind the
    aggregation of :func:`views_per_user`, and on a table.
    """
    return (
        per_user.groupBy("window", "product_id")
        .agg(
            F.sum("views").alias("view_count"),
            F.count("user_id").alias("unique_users"),
            F.sum("seconds").alias("seconds"),
            F.sum("timed_views").alias("timed_views"),
        )
        .select(
            "product_id",
            iso_text(F.col("window.start")).alias("window_start"),
            "view_count",
            "unique_users",
            mean(F.col("seconds"), F.col("timed_views")).alias("avg_duration_sec"),
        )
    )


def product_view_counters(views: DataFrame, delay: str = "1 day") -> DataFrame:
    """The counters of each day once it is over, for an endless stream in append mode."""
    return view_counters(views_per_user(views, delay))


def payment_windows(payments: DataFrame, length: str, slide: str | None = None, delay: str = "1 day") -> DataFrame:
    """Number and sum of payments per method and window; ``payments`` needs ``ts, payment_method, total``."""
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    return (
        payments.withWatermark("ts", delay)
        .groupBy(window, "payment_method")
        .agg(F.count("*").alias("payments"), F.sum("total").alias("sum"))
        .select(
            "payment_method",
            F.lit("sliding" if slide else "tumbling").alias("kind"),
            iso_text(F.col("window.start")).alias("window_start"),
            "payments",
            money(F.col("sum")).alias("revenue"),
        )
    )


def daily_payments(payments: DataFrame, delay: str = "1 day") -> DataFrame:
    """Number and sum of payments per method and day, for :func:`run_update`."""
    return (
        payments.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 day"), "payment_method")
        .agg(F.count("*").alias("payments"), F.sum("total").alias("sum"))
    )


def windows_of_days(daily: DataFrame, days: int, kind: str) -> DataFrame:
    """Windows of ``days`` days that begin on each day, from the figures per day: a day adds to ``days`` windows."""
    first = F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda k: F.col("window.start") - F.make_dt_interval(k)))
    return (
        daily.select("payment_method", first.alias("start"), "payments", "sum")
        .groupBy("payment_method", "start")
        .agg(F.sum("payments").alias("payments"), F.sum("sum").alias("sum"))
        .select(
            "payment_method",
            F.lit(kind).alias("kind"),
            iso_text(F.col("start")).alias("window_start"),
            "payments",
            money(F.col("sum")).alias("revenue"),
        )
    )


def activity(events: DataFrame, gap_seconds: int, delay: str = "1 day") -> DataFrame:
    """Events per user and slice of a sixth of the gap, for :func:`run_update`; a slice lies within one session."""
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", f"{gap_seconds // 6} seconds"), "user_id")
        .agg(F.count("*").alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    )


def sessions_of_activity(slices: DataFrame, gap_seconds: int) -> DataFrame:
    """Sessions per user from the slices; the window runs over slices, of which a user has as many as time has passed."""
    in_order = Window.partitionBy("user_id").orderBy("first_ts")
    since_previous = F.unix_micros("first_ts") - F.unix_micros(F.lag("last_ts").over(in_order))
    opens = F.coalesce(since_previous > gap_seconds * 1_000_000, F.lit(True))
    return (
        slices.withColumn("opens", opens)
        .withColumn("number", F.count_if("opens").over(in_order))
        .groupBy("user_id", "number")
        .agg(F.min("first_ts").alias("start"), F.max("last_ts").alias("end"), F.sum("events").alias("event_count"))
        .select("user_id", iso_text(F.col("start")).alias("start_time"), iso_text(F.col("end")).alias("end_time"), "event_count")
    )


def sessions(events: DataFrame, gap: str = "6 hours", delay: str = "1 day") -> DataFrame:
    """Sessions per user; ``events`` needs ``ts, user_id``."""
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.session_window("ts", gap), "user_id")
        .agg(F.count("*").alias("event_count"), F.max("ts").alias("last_ts"))
        .select(
            "user_id",
            iso_text(F.col("session_window.start")).alias("start_time"),
            iso_text(F.col("last_ts")).alias("end_time"),
            "event_count",
        )
    )


def deduplicated(events: DataFrame, key: str = "event_id", delay: str = "1 day") -> DataFrame:
    """Each key once, however often it is delivered within the delay."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def version(base: str, batch_id: int) -> str:
    return f"{base}/version={batch_id:012d}"


# --- running to the end of the available input -------------------------------------


def file_stream(spark: SparkSession, path: str, *columns: str, per_batch: int | None = None) -> DataFrame:
    """A stream over a Parquet file or folder, with the schema of the files there now.

    The path is given as a pattern that matches only itself: a stream accepts a single
    file only through a pattern.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    stream = reader.parquet(f"{path[:-1]}[{path[-1]}]")
    return stream.selectExpr(*columns) if columns else stream


def run_append(result: DataFrame, purpose: str) -> DataFrame:
    """Run an append-mode job over all available input and read what it wrote."""
    spark = result.sparkSession
    base = fresh_dir(spark, purpose)
    query = (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{base}/out")


def run_complete(
    result: DataFrame, purpose: str, finish: Callable[[DataFrame], DataFrame] = lambda table: table
) -> DataFrame:
    """Run an aggregation over all available input and read it whole, open windows included.

    For backfills and other input that ends: the table of all groups is written anew after each batch, by ``finish``,
    and the last one read. A batch that is run again writes the same version again.
    """
    spark = result.sparkSession
    base = fresh_dir(spark, purpose)
    query = (
        result.writeStream.foreachBatch(
            lambda table, batch_id: finish(table).write.mode("overwrite").parquet(version(f"{base}/table", batch_id))
        )
        .outputMode("complete")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    written = [p["batchId"] for p in query.recentProgress]
    schema = finish(spark.createDataFrame([], result.schema)).schema
    if not written:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version(f"{base}/table", max(written)))


def run_upsert(stream: DataFrame, key: str, order: list[str], purpose: str, parts: int = 64) -> DataFrame:
    """Keep the latest row per key of all available input in a stored table, and read it.

    A batch rewrites only the partitions of its keys.
    """
    spark = stream.sparkSession
    base = fresh_dir(spark, purpose)
    table = KeyedTable(spark, f"{base}/table", stream.schema, [key], order, hashed(key, parts=parts))
    _run(stream.writeStream.foreachBatch(table.merge), base)
    return table.read()


def run_update(
    groups: DataFrame, keys: list[str], purpose: str, base: str | None = None, folders: str = "yyyy-MM-dd"
) -> tuple[DataFrame, StreamingQuery]:
    """Run an aggregation by time windows over all available input in update mode and read its stored groups.

    ``groups`` has a column ``window`` besides ``keys``. A batch gives only the groups it has changed, whole, and merges them into the
    table's partitions of their days, or of longer times by the pattern ``folders``. Once the watermark has passed a window it leaves the state and stays in the table, so the state is
    bounded and the table holds closed and open windows alike. ``base`` is the folder of the table and the checkpoint: given the same one, a later run
    goes on where the last has stopped.
    """
    spark = groups.sparkSession
    base = base or fresh_dir(spark, purpose)
    day = F.date_format("window.start", folders)
    stamped = groups.withColumn("batch", F.lit(0).cast("bigint"))
    table = KeyedTable(spark, f"{base}/table", stamped.schema, ["window", *keys], ["batch"], day)

    def merge(rows: DataFrame, batch_id: int) -> None:
        table.merge(rows.withColumn("batch", F.lit(batch_id).cast("bigint")), batch_id)

    query = _run(groups.writeStream.foreachBatch(merge).outputMode("update"), base)
    return table.read().drop("batch"), query


def _run(writer: DataStreamWriter, base: str) -> StreamingQuery:
    query = writer.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return query
