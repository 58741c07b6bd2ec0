"""The corpus pipeline: five stages from documents to a weighted mixture of sources."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import decontaminate, jaccard, langid, mixing, names, queries, substrings
from souk.session import materialize

#: A language less sure than this is none.
MIN_LANGUAGE_SCORE = 0.5


@queries.shipped
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those that fit no learned language better than the others."""
    held, columns = names.aside(docs, langid.ADDED)
    named = langid.classify(held, F.lit(True))
    return named.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*columns)


@queries.shipped
def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, by five-word shingles with a similarity of 0.8, the document with the smallest id stays."""
    return jaccard.one_of_each_group(docs)


@queries.shipped
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; passages that stand in an earlier one are cut out of their texts."""
    held, columns = names.aside(docs, substrings.ADDED)
    cut = substrings.without_repeats(held).select(*columns)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@queries.shipped
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a question of the benchmark, also with other numbers, names or units."""
    return decontaminate.without_leaks(docs, queries.table(spark, sf_dir, "benchmark"))


@queries.shipped
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes, with their domain and the number of passes; columns of these names are replaced."""
    held, columns = names.aside(docs.select(*names.others(docs.columns, ("domain", "epochs"))), ("leaf_given",))
    mixed = mixing.mix(held, queries.domain(), queries.WEIGHTS, queries.BUDGET, queries.MAX_EPOCHS, queries.SEED)
    return mixed.where("epochs > 0").select(*columns, "domain", "epochs")


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("substrings", cut_repeated_passages),
    ("benchmark", drop_benchmark_leaks),
    ("mix", mix_sources),
]

#: Language models and byte hashes are no SQL; tests hold the rows against a plain version.
ORACLE_SQL = None


@queries.shipped
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage reads what the one before has written."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
