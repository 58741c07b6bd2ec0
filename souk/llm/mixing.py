"""Mixing sources to target weights by hierarchical budgets over a domain-language-source tree.

A token budget runs down the tree. At each node it is shared among the children by weight, up to what
their subtrees can give in ``max_epochs`` passes; what a child cannot take goes to its siblings, and
only what a whole subtree cannot take goes to the siblings of its ancestors. A leaf gives full passes and then
the beginning of one more, in an order seeded for that pass. All of it is DataFrame operations: sums per
leaf, windows over siblings, and a cut key per leaf that the documents are compared with.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from souk.llm.names import free, others
from souk.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the order key that a leaf's tokens are first added up by: 4096 buckets.
BUCKET_DIGITS = 3
LEVELS = ("_domain", "_lang", "_source")


def weight(column: str, weights: dict[str, int]) -> Column:
    """The whole-number weight of a name; names not listed weigh 1, listed ones may weigh 0."""
    out = F.lit(1)
    for name, value in weights.items():
        out = F.when(F.col(column) == name, value).otherwise(out)
    return out.cast("long")


def order_key(id_col: str, seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.col(id_col).cast("string")))


def share(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """``nodes (.., name, budget, cap, weight)`` with ``given``: the budget of each parent shared among its children.

    Children in order of capacity by weight are full as long as the rest of the budget, shared by
    weight, reaches their capacity; the others share what is left. Amounts are whole tokens, rounded down.
    """
    family = Window.partitionBy(*parents)
    ranked = family.orderBy((F.col("cap") / F.when(F.col("weight") > 0, F.col("weight"))).asc_nulls_last(), "name")
    before = F.coalesce(F.sum("cap").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(ranked.rowsBetween(0, Window.unboundedFollowing))
    full = (F.col("weight") > 0) & (
        F.col("cap").cast("double") * F.col("_rest") <= (F.col("budget") - F.col("_before")).cast("double") * F.col("weight")
    )
    left = F.col("budget") - F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(family)
    open_weight = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(family)
    part = F.floor(F.col("_left").cast("double") * F.col("weight") / F.col("_open"))
    given = F.when(F.col("_full"), F.col("cap")).when(F.col("_open") > 0, F.least(F.col("cap"), part)).otherwise(0)
    return (
        nodes.withColumn("_before", before)
        .withColumn("_rest", rest)
        .withColumn("_full", full)
        .withColumn("_left", left)
        .withColumn("_open", open_weight)
        .withColumn("given", given.cast("long"))
        .drop("_before", "_rest", "_full", "_left", "_open")
    )


def budgets(leaves: DataFrame, budget_share: float, max_epochs: int, weights: list[dict[str, int]]) -> DataFrame:
    """``leaves (_domain, _lang, _source, tokens)`` with the tokens ``given`` to each."""
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    total = leaves.agg(F.floor(F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(float(budget_share))).alias("budget"))
    given = total
    for depth, level in enumerate(LEVELS):
        keys = list(LEVELS[: depth + 1])
        nodes = caps.groupBy(*keys).agg(F.sum("cap").alias("cap")).withColumn("weight", weight(level, weights[depth]))
        nodes = nodes.withColumn("name", F.col(level))
        if depth:
            above = given.select(*[F.col(k).alias(f"up{k}") for k in keys[:-1]], F.col("given").alias("budget"))
            match = [F.col(k).eqNullSafe(F.col(f"up{k}")) for k in keys[:-1]]
            nodes = nodes.join(above, match[0] if len(match) == 1 else match[0] & match[1]).select(*keys, "cap", "weight", "name", "budget")
        else:
            nodes = nodes.join(total, F.lit(True), "left")  # one row
        given = share(nodes, keys[:-1] or [F.lit(1)]).select(*keys, "given")
    same = F.lit(True)
    for k in LEVELS:
        same = same & F.col(k).eqNullSafe(F.col(f"to{k}"))
    renamed = given.select(*[F.col(k).alias(f"to{k}") for k in LEVELS], "given")
    return leaves.join(renamed, same).select(*LEVELS, "tokens", "given")


def leaf_plans(
    docs: DataFrame,
    domain: Column,
    budget_share: float,
    max_epochs: int,
    weights: list[dict[str, int]],
    seed: int,
    id_col: str,
    text_col: str,
    lang_col: str,
    source_col: str,
) -> DataFrame:
    """Per leaf its full passes and the last order key of the pass that is not full (null: none)."""
    tokens = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    light = materialize(
        docs.select(
            F.col(id_col).alias("_id"), domain.alias("_domain"), F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source"), tokens.alias("_n")
        ),
        "token-counts",
    )
    leaves = light.groupBy(*LEVELS).agg(F.sum("_n").alias("tokens"))
    plan = budgets(leaves, budget_share, max_epochs, weights)
    full = F.when(F.col("tokens") > 0, F.floor(F.col("given") / F.col("tokens"))).otherwise(0).cast("long")
    plan = plan.withColumn("full", full).withColumn("rest", F.col("given") - F.col("full") * F.col("tokens"))
    plan = materialize(plan, "leaf-budgets")
    open_leaves = plan.where("rest > 0").select(*[F.col(k).alias(f"of{k}") for k in LEVELS], "full", "rest")
    same = F.lit(True)
    for k in LEVELS:
        same = same & F.col(k).eqNullSafe(F.col(f"of{k}"))
    rows = light.join(open_leaves, same).withColumn("_key", order_key("_id", seed, F.col("full") + 1))
    rows = rows.withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    # whole buckets first; only the bucket in which the rest ends is put in order
    sums = rows.groupBy(*LEVELS, "_bucket").agg(F.sum("_n").alias("_sum"), F.max("rest").alias("rest"))
    run = Window.partitionBy(*LEVELS).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(run), F.lit(0)))
    last = sums.where("_before < rest and _before + _sum >= rest").select(
        *[F.col(k).alias(f"in{k}") for k in LEVELS], F.col("_bucket").alias("_in_bucket"), "_before"
    )
    inside = F.col("_bucket") == F.col("_in_bucket")
    for k in LEVELS:
        inside = inside & F.col(k).eqNullSafe(F.col(f"in{k}"))
    ordered = Window.partitionBy(*LEVELS).orderBy("_key", "_n").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        rows.join(last, inside)
        .withColumn("_so_far", F.col("_before") + F.coalesce(F.sum("_n").over(ordered), F.lit(0)))
        .where("_so_far < rest")
        .groupBy(*[F.col(k).alias(f"cut{k}") for k in LEVELS])
        .agg(F.max("_key").alias("cut_key"))
    )
    same = F.lit(True)
    for k in LEVELS:
        same = same & F.col(k).eqNullSafe(F.col(f"cut{k}"))
    return plan.join(cut, same, "left").select(*LEVELS, F.col("tokens").alias("_leaf_tokens"), "given", "full", "cut_key")


def mix(
    docs: DataFrame,
    domain: Column,
    weights: list[dict[str, int]],
    budget_share: float = 1.0,
    max_epochs: int = 4,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` with ``domain``, ``epochs`` (passes that take the row, 0 for none) and ``leaf_given``; columns of these names are replaced.

    The budget is ``budget_share`` of all words of ``docs``; ``weights`` are those of domains, languages and sources. Null
    names are a node of their own and weigh 1. Null and empty texts have no words and follow their leaf's order.
    Rows with one id have one place in the order. An empty table gives no rows.
    """
    plan = materialize(
        leaf_plans(docs, domain, budget_share, max_epochs, weights, seed, id_col, text_col, lang_col, source_col), "leaf-plans"
    )
    names = others(docs.columns, ("domain", "epochs", "leaf_given"))
    at_domain = free("_at_domain", docs.columns)
    own = {c: free(c, [*docs.columns, at_domain]) for c in plan.columns}
    named = docs.withColumn(at_domain, domain)
    same = F.lit(True)
    for held, level in zip((at_domain, lang_col, source_col), LEVELS, strict=True):
        same = same & F.col(held).eqNullSafe(F.col(own[level]))
    extra = (order_key(id_col, seed, F.col(own["full"]) + 1) <= F.col(own["cut_key"])).cast("long")
    epochs = (F.col(own["full"]) + F.coalesce(extra, F.lit(0))).cast("int")
    return named.join(plan.withColumnsRenamed(own), same).select(
        *names, F.col(at_domain).alias("domain"), epochs.alias("epochs"), F.col(own["given"]).alias("leaf_given")
    )
