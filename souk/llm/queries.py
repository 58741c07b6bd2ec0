"""The registered queries of the text operators, over whole tables with production parameters."""

import functools
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import (
    conversations,
    decontaminate,
    extract,
    langid,
    mixing,
    pitman_yor,
    quality,
    runs,
    simhash,
    substrings,
    token_files,
    tokens,
    toxicity,
)

#: Sources of each domain; the rest are of the last one. The table has no domain of its own.
DOMAINS = {
    "web": tuple(f"src{k}" for k in range(0, 8)),
    "books": tuple(f"src{k}" for k in range(8, 14)),
    "reference": tuple(f"src{k}" for k in range(14, 20)),
}
OTHER_DOMAIN = "other"
#: Weights of domains, languages and sources; names not listed weigh 1.
WEIGHTS = [{"web": 4, "books": 3, "reference": 2}, {"en": 5, "de": 2, "fr": 2, "es": 2}, {}]
#: Budget as a share of the corpus, passes at most, and the seed of their orders.
BUDGET, MAX_EPOCHS, SEED = 1.0, 4, 42
#: The id that ends each document in files of token ids.
END_ID = 1


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query, with this package sent to the executors first, once for a Spark context."""

    @functools.wraps(query)
    def run(spark: SparkSession, *rest) -> DataFrame:
        context = spark.sparkContext
        if getattr(context, "souk_sent", None) is None:
            root = Path(__file__).resolve().parents[2]
            context.souk_sent = shutil.make_archive(f"{tempfile.mkdtemp(prefix='souk-')}/souk", "zip", root, "souk")
            context.addPyFile(context.souk_sent)
        return query(spark, *rest)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, parts: int) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % parts


def domain() -> Column:
    out = F.lit(OTHER_DOMAIN)
    for name, sources in DOMAINS.items():
        out = F.when(F.col("source").isin(*sources), name).otherwise(out)
    return out


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = substrings.without_repeats(docs)
    return cut.select("doc_id", "text", F.col("_cuts").alias("n_cuts"), F.col("_cut_words").alias("n_cut_words"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    named = langid.classify(docs, fold("doc_id", 5) != 0)
    return named.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op3_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.rated(table(spark, sf_dir, "documents"))
    return rated.drop("distance")


def op5_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = toxicity.score(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return rated.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.with_limit(counted).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, domain(), WEIGHTS, BUDGET, MAX_EPOCHS, SEED)
    return mixed.select("doc_id", "domain", "lang", "source", "leaf_given", "epochs")


def op10_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = pitman_yor.score(docs, fold("doc_id", 7) != 2)
    return scored.select(
        "doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op11_elias_fano_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.stored(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = docs.select("doc_id", runs.periodic(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.with_runs(made)
    # by exact length / period, then the earlier and the shorter
    more = F.array_sort(
        "runs",
        lambda a, b: F.coalesce(
            F.nullif(F.signum(b["length"] * a["period"] - a["length"] * b["period"]).cast("int"), F.lit(0)),
            F.nullif(F.signum(a["start"] - b["start"]).cast("int"), F.lit(0)),
            F.signum(a["period"] - b["period"]).cast("int"),
        ),
    )
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    best = found.withColumn("best", F.get(more, F.lit(0)))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    repaired = conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))
    return repaired.withColumnRenamed("conv", "conv_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: shipped(f)
        for f in (
            op1_substring_dedup,
            op2_language_id,
            op3_simhash_near_duplicates,
            op4_quality_outliers,
            op5_template_leaks,
            op6_toxicity,
            op7_main_text,
            op8_token_counts,
            op9_source_mix,
            op10_pitman_yor_scores,
            op11_elias_fano_tokens,
            op12_periodic_runs,
            op13_conversation_repair,
        )
    }
