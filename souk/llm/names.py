"""Names for working columns that no column of the input has; Spark tells names apart without regard to case."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free(name: str, columns: Iterable[str]) -> str:
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def others(columns: Iterable[str], replaced: Iterable[str]) -> list[str]:
    gone = {c.lower() for c in replaced}
    return [c for c in columns if c.lower() not in gone]


def aside(docs: DataFrame, added: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with free names for its columns that an operator would replace, and what selects all columns under their own names again."""
    added = {a.lower() for a in added}
    held = {c: c for c in docs.columns}
    for c in docs.columns:
        if c.lower() in added:
            held[c] = free(c, [*held.values(), *added])
    return docs.withColumnsRenamed({c: h for c, h in held.items() if c != h}), [F.col(h).alias(c) for c, h in held.items()]
