"""Stored tables that take batches of new and changed rows, each batch rewriting only the partitions its keys are in.

A table is a Parquet folder partitioned by a column made from the key: a hash, a day, a prefix. A batch is merged with the
stored rows of its own partitions, and these replace the old ones by a dynamic partition overwrite; files of other partitions stay as they are.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.session import discard, exists, rename

#: The partition column of a stored table.
PART = "part"


def hashed(*columns: str | Column, parts: int = 64) -> Column:
    """Partitions of about equal size, for keys without an order that reads could use."""
    return F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int")


class KeyedTable:
    """A table with one row per key: the one that comes last by ``order``; ties go by the other columns.

    ``part`` is the partition of a row, an integer or a text, made from key columns only. The columns of ``sort`` order the rows within files.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, key: list[str], order: list[str], part: Column, sort: list[str] | None = None
    ):
        self.spark, self.path, self.schema = spark, path, schema
        self.key, self.order, self.part, self.sort = key, order, part, sort or key

    @property
    def rows_path(self) -> str:
        return f"{self.path}/rows"

    def read(self, where: Column | None = None) -> DataFrame:
        """The stored rows; conditions on ``PART`` choose folders, others are pushed into the files."""
        if not exists(self.spark, self.rows_path):
            return self.spark.createDataFrame([], self.schema)
        stored = self._parted(self.rows_path)
        return (stored if where is None else stored.where(where)).select(*self.schema.names)

    def _parted(self, path: str) -> DataFrame:
        part = self.spark.createDataFrame([], self.schema).select(self.part.alias(PART)).schema[PART]
        return self.spark.read.schema(StructType([*self.schema.fields, part])).parquet(path)

    def _last(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in self.schema.names if c not in self.key]
        first = [*self.order, *[c for c in rest if c not in self.order]]
        row = F.max(F.struct(*first)).alias("row")
        return rows.groupBy(*self.key).agg(row).select(*self.key, *[F.col("row")[c].alias(c) for c in rest])

    def _write(self, rows: DataFrame, path: str) -> None:
        mode = "dynamic" if path == self.rows_path else "static"  # aside, a whole write leaves its mark
        # adaptive execution gives a large partition several writers and small ones a common one
        parted = rows.withColumn(PART, self.part).hint("rebalance", PART)
        writer = parted.sortWithinPartitions(PART, *self.sort).write.mode("overwrite").partitionBy(PART)
        writer.option("partitionOverwriteMode", mode).parquet(path)

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """Merge the rows of a batch; a batch that is run again, also after a failure half-way, leaves the same table.

        The merged partitions are written aside first. From then on the batch is finished from there and never reads the table again,
        whose partitions may be gone or replaced. They go when the next batch is complete. The number of partitions a batch touches
        is at most that of the table; their values pass through the driver.
        """
        aside = f"{self.path}/batch={batch_id:012d}"
        ready = f"{aside}/merged"
        if not exists(self.spark, f"{aside}/merged/_SUCCESS"):
            # once: a batch of a stream is not computed again, and its partitions are its folders
            self._write(self._last(batch.select(*self.schema.names)), f"{aside}/changed")
            changed = self._parted(f"{aside}/changed")
            touched = [row[0] for row in changed.select(PART).distinct().collect()]
            if not touched:
                discard(self.spark, aside)
                return
            if not exists(self.spark, self.rows_path):  # nothing to merge with: the rows become the table
                rename(self.spark, f"{aside}/changed", self.rows_path)
                return
            inside = F.col(PART).isin([t for t in touched if t is not None])
            if None in touched:
                inside |= F.col(PART).isNull()
            both = changed.select(*self.schema.names).unionByName(self.read(inside))
            self._write(self._last(both), ready)
        self._write(self._parted(ready).select(*self.schema.names), self.rows_path)
        if batch_id:
            discard(self.spark, f"{self.path}/batch={batch_id - 1:012d}")


def keyed_sessions(spark: SparkSession, path: str, schema: StructType, parts: int = 64) -> KeyedTable:
    """The stored table of sessions by row key, the cells of :func:`souk.operators.keyed.keyed_cells`: all sessions of a user are in
    one partition, in the order of the key, and of sessions with one key the last id stays."""
    return KeyedTable(spark, path, schema, ["row_key"], ["sess_session_id"], hashed(_user("row_key"), parts=parts))


def _user(row_key: str) -> Column:
    return F.substring_index(row_key, "#", 1)


def sessions_of_user(table: KeyedTable, user_id: str) -> DataFrame:
    """The stored sessions of one user: the scan opens the partition of the user and reads one range of keys."""
    key = F.col("row_key")
    inside = (key >= f"{user_id}#") & (key < f"{user_id}$")
    user = table.spark.range(1).select(F.lit(f"{user_id}#").alias("row_key")).select(table.part).first()[0]
    return table.read((F.col(PART) == user) & inside)
