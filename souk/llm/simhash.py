"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

A 64-bit fingerprint is eight bytes at fixed positions. Two fingerprints that differ in at
most three bits differ in at most three bytes, so they share at least five positional bytes.
The index holds triples of positional bytes within each half of four positions: five
shared bytes put three into one half, so every such pair meets in at least one of the eight
posting lists per fingerprint. In a list the shared positional bytes of a pair are
tallied, pairs below five are dropped and the rest verified by their bits.

Long posting lists are cut into blocks whose pairs of blocks are separate groups, and a group
hands on a spanning forest of its verified links instead of all of them; reachability is
the same and the rows stay in proportion to the members.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.arrays import LOWER, text_slices, words
from souk.llm.components import components
from souk.llm.names import free
from souk.session import materialize

SEED = 42
MAX_BITS = 3
#: Positional bytes that any pair within MAX_BITS shares.
MIN_BYTES = 8 - MAX_BITS
#: Byte positions of the index keys: all triples within either half.
TRIPLES = [t for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for t in combinations(half, 3)]
#: Members of a posting list that are compared within one group.
BLOCK = 2048


def text_fingerprints(data: np.ndarray, offsets: np.ndarray, size: int = 3) -> np.ndarray:
    """The fingerprint of each document of a slice; shingles of ``size`` words, repeats included."""
    starts, ends, doc = words(data, offsets)
    n = len(offsets) - 1
    counts = np.bincount(doc, minlength=n)
    lengths = ends - starts
    # the words of a document, one space apart
    placed = np.concatenate(([0], np.cumsum(lengths + 1)))
    norm = np.full(placed[-1], 32, np.uint8)
    at = np.repeat(placed[:-1] - starts, lengths) + _ranges(starts, lengths)
    norm[at] = LOWER[data[_ranges(starts, lengths)]]
    whole = norm.tobytes()
    first = np.cumsum(counts) - counts
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    head = np.repeat(first, shingles) + _ranges(np.zeros(n, np.int64), shingles)
    tail = head + np.repeat(np.minimum(counts, size), shingles) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(whole[a:b], SEED) for a, b in zip(placed[head].tolist(), (placed[tail] + lengths[tail]).tolist(), strict=True)),
        np.uint64,
        len(head),
    )
    out = np.zeros(n, np.uint64)
    held = np.flatnonzero(shingles)
    if len(held):
        begin = (np.cumsum(shingles) - shingles)[held]
        rows = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(rows, axis=1)
        set_bits = np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
        over = 2 * set_bits > shingles[held, None]
        out[held] = np.packbits(over, axis=1).reshape(-1).view(">u8").astype(np.uint64)
    return out


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of each range, one range after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint of every whole text as a signed long.

    A null or blank text has fingerprint zero. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(1)):
                found = text_fingerprints(data, offsets, size).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(found)], ["doc_id", "fp"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, fp long")


def _byte(position: int):
    return F.shiftrightunsigned("fp", 56 - 8 * position).bitwiseAND(F.lit(255))


def postings(prints: DataFrame) -> DataFrame:
    """``(slot, bytes, fp)``: each distinct fingerprint under its eight index keys."""
    keys = [
        F.struct(
            F.lit(slot).alias("slot"),
            (_byte(a) * 65536 + _byte(b) * 256 + _byte(c)).cast("int").alias("bytes"),
        )
        for slot, (a, b, c) in enumerate(TRIPLES)
    ]
    return prints.select("fp", F.explode(F.array(*keys)).alias("key")).select("key.slot", "key.bytes", "fp")


def forest(left: np.ndarray, right: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over the verified pairs between two blocks."""
    everyone = left if same else np.concatenate((left, right))
    label = np.arange(len(everyone))
    out: list[tuple[int, int]] = []
    shift = 0 if same else len(left)
    for i, value in enumerate(left):
        low = i + 1 if same else shift
        differing = everyone[low:] ^ value
        shared = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = np.flatnonzero(shared >= MIN_BYTES)
        near = near[np.bitwise_count(differing[near]) <= MAX_BITS] + low
        others, where = np.unique(label[near], return_index=True)
        new = others != label[i]
        if new.any():
            out += [(i, j) for j in near[where[new]].tolist()]
            label[np.isin(label, others[new])] = label[i]
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return everyone[pairs[:, 0]], everyone[pairs[:, 1]]


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(a, b)`` fingerprints within ``MAX_BITS`` bits; all others are reachable over these."""
    index = postings(prints)
    lists = index.groupBy("slot", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    lists = lists.select("slot", "bytes", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    members = index.join(lists, ["slot", "bytes"]).withColumn(
        "own", F.expr("cast(pmod(xxhash64(fp), blocks) as int)")
    )
    sides = F.expr("transform(sequence(0, blocks - 1), o -> struct(least(o, own) as i, greatest(o, own) as j))")
    grid = members.select("slot", "bytes", "own", "fp", F.explode(sides).alias("g"))

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        i, j = key[2], key[3]
        prints_of = {k: np.sort(g.to_numpy().view(np.uint64)) for k, g in group.groupby("own")["fp"]}
        none = np.zeros(0, np.uint64)
        a, b = forest(prints_of.get(i, none), prints_of.get(j, none), i == j)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    flat = grid.select("slot", "bytes", F.col("g.i").alias("i"), F.col("g.j").alias("j"), "own", "fp")
    return flat.groupBy("slot", "bytes", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)``: every document with the smallest id reachable over links.

    Texts with the same fingerprint are linked, nulls and blanks (fingerprint zero) too. A repeated row is
    returned as often as it is there. An empty table gives no rows.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, size), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    joined = components(links(distinct.select("fp")))
    member = distinct.join(joined, distinct["fp"] == joined["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = member.join(least, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates with all its columns: that of the smallest id.

    A null id comes after all others, so that a row without an id stays if no row with one is in its group. Of rows with the
    same id in a group, repeated ones too, one stays. Null and blank texts are one group.
    """
    row = free("_row", docs.columns)
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-rows")
    ids = rows.select(F.col(row).alias("at"), F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row")).alias("rank"))
    groups = near_duplicates(rows, row, text_col).select(F.col("doc_id").alias("at"), "component_id")
    kept = groups.join(ids, "at").groupBy("component_id").agg(F.min("rank").alias("rank"))
    return rows.join(kept.select(F.col("rank.row").alias(row)), row, "left_semi").select(*docs.columns)
