"""Reading the nested entities from JSON array files or stored tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.schemas import ENTITIES

#: Text of a record that does not have the schema; null for the others.
MALFORMED = "malformed_text"
#: What stands before each record of an array that is indented by two blanks. Text within quotes has no line ends.
RECORD_START = "\n  {"


def read_json_array(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Read indented JSON arrays; a lone object counts as one row. ``path`` may be a glob.

    A missing path or a malformed text is an error. An array is read by one task per file: large entities come as shards.
    """
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_json_records(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """The records of JSON arrays, read by any number of tasks per file; malformed ones keep their text in ``MALFORMED`` and are null elsewhere.

    Arrays indented by two blanks are cut before each record. A file of another layout is one piece, read by one task: an array, or
    a lone object as one row. Such a piece is malformed as a whole if it is no JSON at all. A record whose values do not
    fit the schema is malformed; a file without text has no records. A file cut short exactly between two records is not noticed, nor are an
    array that is indented in part and a lone object indented by one blank told from broken ones: they give malformed pieces.
    """
    pieces = spark.read.option("lineSep", RECORD_START).text(path).select(F.trim(F.col("value"), F.lit(" \t\r\n")).alias("piece"))
    piece = F.col("piece")
    # Behind the opening brace of a record stands neither of these.
    first = piece.startswith("[") | piece.startswith("{")
    record = F.concat(F.lit("{"), F.regexp_replace(piece, r"(?:,|\s*+\])$", ""))
    elements = F.from_json(piece, "array<string>", {"mode": "PERMISSIVE"})
    texts = (
        F.when(~first, F.array(record))
        .when(piece.startswith("{"), F.array(piece))
        .otherwise(F.coalesce(elements, F.array(piece)))
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    text = F.coalesce("text", F.lit("null"))
    return (
        # The bracket that opens an indented array is a piece of its own.
        pieces.where(~piece.isin("", "["))
        .select(F.explode(texts).alias("text"))
        .select(text.alias("text"), F.from_json(text, f"{schema}, {MALFORMED} STRING", options).alias("row"))
        .withColumn("row", F.when(F.col(f"row.{MALFORMED}").isNull(), F.col("row")))
        .select("row.*", F.when(F.col("row").isNull(), F.col("text")).alias("text"))
        .drop(MALFORMED)
        .withColumnRenamed("text", MALFORMED)
    )


def entity_path(folder: str, entity: str) -> str:
    """The files of one entity; sessions come as any number of numbered shards."""
    return f"{folder}/sessions_*.json" if entity == "sessions" else f"{folder}/{entity}.json"


def read_entity(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    return read_json_array(spark, entity_path(folder, entity), ENTITIES[entity])


def read_entity_records(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    """The same with malformed records set apart in ``MALFORMED``."""
    return read_json_records(spark, entity_path(folder, entity), ENTITIES[entity])


def load(
    spark: SparkSession,
    entity: str,
    table_folder: str,
    json_folder: str,
    json_names: list[str] | None = None,
    missing: list[str] | None = None,
) -> DataFrame:
    """Read the stored table if there is one, else the JSON files.

    A file that is not there is an error, unless ``missing`` is given: then its path is added to that list and the others
    are read.
    """
    try:
        return spark.read.parquet(f"{table_folder}/{entity}").drop("_id")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    found = None
    for path in [f"{json_folder}/{name}" for name in json_names or [f"{entity}.json"]]:
        try:
            rows = read_json_array(spark, path, ENTITIES[entity])
        except AnalysisException as error:
            if missing is None or error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(path)
            continue
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], ENTITIES[entity]) if found is None else found


def register_views(**tables: DataFrame) -> None:
    """Make the given tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
