"""Session helpers: a local session for tests, and the shared work folder."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession


def local_session(cpus: int = 8, memory: str = "8g") -> SparkSession:
    """A one-machine session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("souk")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session without the setting gets a temporary folder of its own;
    on a cluster a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="souk-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/souk/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder whose rows nothing will read again; one that is not there is no error."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name, in one step where the file system has one."""
    system, place = _file_system(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    if not system.rename(place, target):
        raise OSError(f"cannot rename {path} to {to}")


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once so that several passes over it do not recompute its inputs."""
    spark = df.sparkSession
    path = fresh_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession, rows: int, rows_of_task: int) -> int | None:
    """Tasks that give each at most about ``rows_of_task`` of ``rows`` rows; None where a few would do, and the session's own way is enough."""
    needed = -(-rows // rows_of_task)
    return max(needed, spark.sparkContext.defaultParallelism) if needed > 4 else None


def dealt(df: DataFrame, tasks: int | None, *keys: str | Column) -> DataFrame:
    """The rows by their keys to so many tasks. The session's width would be the same for any input, so that a task's rows and memory grow with it."""
    return df.repartition(tasks, *keys) if tasks else df
