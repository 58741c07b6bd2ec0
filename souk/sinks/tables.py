"""Writing tables: replace loads, layouts for access paths, CSV and JSON exports."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from souk.operators.quality import require_unique


#: Rows that one writing task puts into a folder, about.
ROWS_PER_FILE = 1_000_000


def replace_table(df: DataFrame, folder: str, name: str, unique: tuple[str, ...] = ()) -> str:
    """Write a table anew, whatever was there; refuses repeated keys if asked to."""
    path = f"{folder}/{name}"
    checked = require_unique(df, name, *unique) if unique else df
    checked.write.mode("overwrite").parquet(path)
    return path


def _spread(df: DataFrame, folders: list[str], by: list[str]) -> DataFrame:
    """Rows of a folder meet in few tasks: one for each ``ROWS_PER_FILE`` of its rows, told apart by the columns ``by``."""
    keys = [F.col(c).alias(f"_{c}") for c in folders]
    writers = df.groupBy(*keys).agg(F.ceil(F.count("*") / ROWS_PER_FILE).alias("_writers"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in folders]
    salted = df.join(writers, same).withColumn("_part", F.pmod(F.xxhash64(*by), "_writers"))
    return salted.repartition(*folders, "_part").select(*df.columns)


def write_by_month(transactions: DataFrame, path: str) -> None:
    """Transactions in one folder per month, sorted by user and newest first within files.

    Month filters skip folders, user filters skip row groups. A month is written by as many
    tasks as its rows ask for, each with users of its own.
    """
    (
        _spread(transactions.withColumn("order_month", F.date_format("ts", "yyyy-MM")), ["order_month"], ["user_id"])
        .sortWithinPartitions("order_month", "user_id", F.desc("ts"))
        .write.mode("overwrite")
        .partitionBy("order_month")
        .parquet(path)
    )


def write_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    """One folder per value, with as many files as its rows ask for.

    Rows that agree in all columns but maps share a file.
    """
    by = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    _spread(df, list(columns), by).write.mode("overwrite").partitionBy(*columns).parquet(path)


def write_keyed(keyed: DataFrame, path: str, files: int | None = None) -> None:
    """A key-sorted table: ranges of ``row_key`` per file, with a bloom filter on the key."""
    ranged = keyed.repartitionByRange(files, "row_key") if files else keyed.repartitionByRange("row_key")
    (
        ranged.sortWithinPartitions("row_key")
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#row_key", "true")
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> int:
    """CSV with a header, also for an empty result; gives back the number of rows written."""
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("header", True).csv(path)
    return written.get["rows"]


def write_json_shards(df: DataFrame, path: str, shards: int = 4) -> None:
    """JSON in a given number of files of about equal size."""
    df.repartition(shards).write.mode("overwrite").json(path)


def preview(df: DataFrame, n: int = 5) -> tuple[DataFrame, int]:
    """The first rows and the number of all rows."""
    return df.limit(n), df.count()
