"""Connected components of a link table, as joins and aggregates with written intermediate tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``links (a, b)``: the smallest node that can be reached.

    Alternates two rewirings until the links no longer change: each node ties its
    larger neighbours to its smallest neighbour, then its smaller ones. Every link keeps
    its component and the number of rounds grows with the logarithm of the longest path. Loops,
    repeated links and either direction are allowed; no links give no rows.
    """
    spark = links.sparkSession
    links = materialize(_tidy(links), "links")
    state = _fingerprint(links)
    while state[0]:
        links = materialize(_small(_large(links)), "links")
        before, state = state, _fingerprint(links)
        if before == state:
            break
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    hubs = links.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return stars.union(hubs).distinct()


def _tidy(links: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller one."""
    return (
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b"), F.col("a")))
    least = both.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("low"))
    least = least.select("hub", F.least("hub", "low").alias("low"))
    return _tidy(
        links.join(least, links["b"] == least["hub"]).select(links["a"], F.col("low").alias("b"))
    )


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("low"))
    moved = links.join(least, links["a"] == least["hub"]).select(links["b"].alias("a"), F.col("low").alias("b"))
    return _tidy(moved.union(least.select(F.col("hub").alias("a"), F.col("low").alias("b"))))
