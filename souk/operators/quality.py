"""Cleaning rules, key checks and row counts."""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from souk.functions.columns import percent, parse_iso, strip

# Fixed values of the cleaning rules.
FALLBACK_TIMESTAMP = "2026-03-07 00:00:00"
SHORTEST_SESSION, LONGEST_SESSION = 1, 14_400


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- transactions -------------------------------------------------------------


def transaction_verdict() -> Column:
    """Why a raw transaction is rejected, or ``kept``."""
    return (
        F.when(F.col("total").isNull() | F.col("user_id").isNull(), "missing_key_field")
        .when(F.col("total") < 0, "negative_total")
        .otherwise("kept")
    )


def clean_transactions(transactions: DataFrame) -> DataFrame:
    """Drop unusable rows, normalize the status, parse the time, add the discount rate."""
    discount = F.coalesce(F.col("discount"), F.lit(0))
    return (
        transactions.where(transaction_verdict() == "kept")
        .withColumn("status", strip(F.lower(F.coalesce("status", F.lit("unknown")))))
        .withColumn("ts", F.coalesce(parse_iso(F.col("timestamp")), F.lit(FALLBACK_TIMESTAMP).cast("timestamp")))
        .withColumn(
            "discount_pct", F.when(F.col("subtotal") > 0, percent(discount, F.col("subtotal"))).otherwise(F.lit(0.0))
        )
    )


def transaction_report(transactions: DataFrame) -> DataFrame:
    """Rows kept and rows rejected by reason, in one scan."""
    return transactions.groupBy(transaction_verdict().alias("reason")).agg(F.count("*").alias("row_count"))


# --- sessions -----------------------------------------------------------------


def session_verdict() -> Column:
    return F.when(F.coalesce("page_view_count", F.lit(0)) > 0, "kept").otherwise("no_page_views")


def clean_sessions(sessions: DataFrame) -> DataFrame:
    """Drop sessions without page views, fill defaults and clamp the duration."""
    duration = F.coalesce("duration_seconds", F.lit(0))
    return (
        sessions.where(session_verdict() == "kept")
        .withColumn("referrer", F.coalesce(F.nullif("referrer", F.lit("")), F.lit("unknown")))
        .withColumn("conversion_status", F.lower(F.coalesce("conversion_status", F.lit("browsing"))))
        .withColumn(
            "duration_seconds",
            F.greatest(F.lit(SHORTEST_SESSION), F.least(duration, F.lit(LONGEST_SESSION))).cast("bigint"),
        )
    )


def session_report(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy(session_verdict().alias("reason")).agg(F.count("*").alias("row_count"))


# --- keys and counts ------------------------------------------------------------


def row_counts(**tables: DataFrame) -> DataFrame:
    return union_all(
        [df.agg(F.lit(name).alias("entity"), F.count("*").alias("row_count")) for name, df in tables.items()]
    )


def duplicates(df: DataFrame, entity: str, *keys: str) -> DataFrame:
    """Key values that occur more than once."""
    return (
        df.groupBy(F.concat_ws("#", *[F.col(k).cast("string") for k in keys]).alias("key_value"))
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
        .select(F.lit(entity).alias("entity"), "key_value", "copies")
    )


def require_unique(df: DataFrame, entity: str, *keys: str) -> DataFrame:
    """``df`` itself, or an error naming one repeated key: the unique index of a load."""
    repeated = duplicates(df, entity, *keys).head(1)
    if repeated:
        raise ValueError(f"{entity}: key {repeated[0].key_value} occurs {repeated[0].copies} times")
    return df


class Relation(NamedTuple):
    """A key of one table that names rows of another."""

    name: str
    parent: str
    parent_key: str
    child: str
    child_key: str


def _key_kind(df: DataFrame, key: str) -> str:
    return "bigint" if isinstance(df.schema[key].dataType, IntegralType) else "string"


def reference_faults(tables: dict[str, DataFrame], relations: list[Relation]) -> DataFrame:
    """Per relation the child rows and keys without a parent, and the parent keys that are not unique.

    Each table is read once for all relations that it is part of: it gives a row for each of its keys, and all rows are counted per key in one grouping
    for whole-number keys and one for others. Counts are made before the shuffle, so a key that holds most rows is one row of each task. Null
    child keys name nothing; keys of two kinds, a number and a text, meet as texts.
    """
    grouped: dict[str, list[Relation]] = {}
    for r in relations:
        kinds = {_key_kind(tables[r.parent], r.parent_key), _key_kind(tables[r.child], r.child_key)}
        grouped.setdefault("bigint" if kinds == {"bigint"} else "string", []).append(r)
    return union_all([_faults_of_kind(tables, same, kind) for kind, same in grouped.items()])


def relation_faults(relation: str, parent: DataFrame, parent_key: str, child: DataFrame, child_key: str) -> DataFrame:
    """:func:`reference_faults` of one relation."""
    return reference_faults({"parent": parent, "child": child}, [Relation(relation, "parent", parent_key, "child", child_key)])


def _faults_of_kind(tables: dict[str, DataFrame], relations: list[Relation], kind: str) -> DataFrame:
    # a domain is a key of a parent; in it role 0 is the parent, the others are its children
    domains: dict[tuple[str, str], list[Relation]] = {}
    for r in relations:
        domains.setdefault((r.parent, r.parent_key), []).append(r)
    keys: dict[str, list[Column]] = {}
    found = []
    missing = (F.col("copies") == 0) & F.col("key").isNotNull()

    def gives(table: str, domain: int, role: int, key: str) -> None:
        row = F.struct(F.lit(domain).alias("domain"), F.lit(role).alias("role"), F.col(key).cast(kind).alias("key"))
        keys.setdefault(table, []).append(row)

    for d, ((parent, parent_key), children) in enumerate(domains.items()):
        gives(parent, d, 0, parent_key)
        for role, r in enumerate(children, 1):
            gives(r.child, d, role, r.child_key)
            rows = F.when((F.col("domain") == d) & missing, F.col(f"rows{role}"))
            found.append(
                F.struct(
                    F.lit(r.name).alias("relation"),
                    F.coalesce(F.sum(rows), F.lit(0)).alias("orphan_rows"),
                    F.count_if(rows > 0).alias("orphan_keys"),
                    F.count_if((F.col("domain") == d) & (F.col("copies") > 1)).alias("repeated_parent_keys"),
                )
            )
    rows = union_all([tables[t].select(F.inline(F.array(*each))) for t, each in keys.items()])
    counts = rows.groupBy("domain", "key").agg(
        F.count_if(F.col("role") == 0).alias("copies"),
        *[F.count_if(F.col("role") == role).alias(f"rows{role}") for role in range(1, 1 + max(map(len, domains.values())))],
    )
    return counts.agg(F.array(*found).alias("found")).select(F.inline("found"))
