"""Session table laid out by row key, and its range reads.

Keys of one user share the prefix ``user#`` and sort newest first. Stored sorted by
key, a range read touches only the files and row groups that hold the range.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.columns import session_key

# The cells of the keyed session table, family first.
CELLS = {
    "sess_session_id": "session_id",
    "sess_start_time": "start_time",
    "sess_end_time": "end_time",
    "sess_duration_seconds": "duration_seconds",
    "sess_conversion_status": "conversion_status",
    "sess_referrer": "referrer",
    "sess_viewed_products": "viewed_products",
    "device_type": "device_type",
    "device_os": "os",
    "device_browser": "browser",
    "device_city": "city",
    "device_state": "state",
    "stats_page_view_count": "page_view_count",
    "stats_cart_size": "cart_size",
}


def keyed_cells(cells: DataFrame) -> DataFrame:
    """Row key and text cells of each session; ``cells`` are the session cells of a shop."""
    return cells.select(
        session_key(F.col("user_id"), F.col("started_at")).alias("row_key"),
        *[F.col(source).cast("string").alias(cell) for cell, source in CELLS.items()],
    )


def last_write_wins(rows: DataFrame, version: Column | str) -> DataFrame:
    """One row per ``row_key``, the one with the highest version.

    An aggregate rather than a window: copies of a key are reduced before the shuffle.
    """
    cells = [c for c in rows.columns if c != "row_key"]
    return (
        rows.groupBy("row_key").agg(F.max_by(F.struct(*cells), version).alias("row")).select("row_key", "row.*")
    )


def session_keyed_table(cells: DataFrame) -> DataFrame:
    """The keyed table; sessions of one user with one start keep the last session id."""
    return last_write_wins(keyed_cells(cells), "sess_session_id")


def _of_user(keyed: DataFrame, user_id: str | Column) -> DataFrame:
    user = F.lit(user_id) if isinstance(user_id, str) else user_id
    return keyed.where((F.col("row_key") >= F.concat(user, F.lit("#"))) & (F.col("row_key") < F.concat(user, F.lit("$"))))


def user_sessions(keyed: DataFrame, user_id: str | Column, limit: int = 10) -> DataFrame:
    """The newest sessions of one user."""
    return (
        _of_user(keyed, user_id)
        .orderBy("row_key")
        .limit(limit)
        .select(
            "row_key",
            *[
                F.coalesce(cell, F.lit("")).alias(name)
                for name, cell in (
                    ("session_id", "sess_session_id"),
                    ("start_time", "sess_start_time"),
                    ("conversion", "sess_conversion_status"),
                    ("device", "device_type"),
                )
            ],
        )
    )


def user_converted_sessions(keyed: DataFrame, user_id: str | Column) -> DataFrame:
    """All converted sessions of one user."""
    return (
        _of_user(keyed, user_id)
        .where(F.col("sess_conversion_status") == "converted")
        .select(
            *[
                F.coalesce(cell, F.lit("")).alias(name)
                for name, cell in (
                    ("session_id", "sess_session_id"),
                    ("start_time", "sess_start_time"),
                    ("products", "sess_viewed_products"),
                )
            ]
        )
    )


def busiest_user(sessions: DataFrame) -> DataFrame:
    """The user with most sessions, as one row."""
    return (
        sessions.groupBy("user_id")
        .agg(F.count("*").alias("sessions"))
        .orderBy(F.desc("sessions"), "user_id")
        .limit(1)
        .select("user_id")
    )


def newest_per_key(rows: DataFrame, key: str, order: list[Column], n: int, rank: str) -> DataFrame:
    """The first ``n`` rows of each key. Spark applies the limit before the shuffle too."""
    position = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn(rank, position.cast("bigint")).where(F.col(rank) <= n)


def recent_sessions_per_user(sessions: DataFrame, n: int = 10) -> DataFrame:
    rows = sessions.select(
        "user_id", session_key(F.col("user_id"), F.col("started_at")).alias("row_key"), "session_id", "start_time"
    )
    return newest_per_key(rows, "user_id", [F.col("row_key"), F.col("session_id")], n, "position")


def keep_last_versions(cells: DataFrame, n: int = 3) -> DataFrame:
    """The last ``n`` versions of the statistics cells of each row key, by ``written``; the newest is version 1."""
    rows = cells.select("row_key", "session_id", "written", "page_view_count", "cart_size")
    return newest_per_key(rows, "row_key", [F.desc("written"), F.desc("session_id")], n, "version")
