"""Near-duplicates by SimHash fingerprints and the Jaccard similarity of word shingles: classes of fingerprints and MinHash bands
find candidates, whole sets verify them.

Two texts are near-duplicates if the sets of their five-word shingles have a similarity of 0.8 or more. The fingerprints of all texts,
of the same shingles, go through the index of :mod:`souk.llm.simhash`; the members of a class, reachable over three bits or fewer, are
candidates. Texts at a similarity of 0.8 mostly differ in more bits, so these are not all: each distinct set gets
twenty band keys of four minima; a pair at similarity 0.8 shares a band with a probability of 1 - (1 - 0.8^4)^20 = 0.99997,
a closer one with a higher one. Bands with the same members are compared once. Only sets that share a band or a class are
built, and every link is verified by the exact similarity.

Long lists are cut into blocks whose pairs of blocks are separate groups, and a group hands on a
spanning forest of its verified links.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm import simhash
from souk.llm.arrays import LOWER, mixed, span_hashes, text_slices, words
from souk.llm.components import components
from souk.session import materialize

SIZE = 5
#: The least similarity, as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
BANDS, MINIMA = 20, 4
#: Members of a band that are compared within one group.
BLOCK = 256

_random = np.random.Generator(np.random.PCG64(5))
_FACTORS = _random.integers(0, 1 << 63, BANDS * MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDED = _random.integers(0, 1 << 63, BANDS * MINIMA, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each document of a slice, in order, and their number; a shorter text is one shingle."""
    low = LOWER[data]
    starts, ends, doc = words(low, offsets)
    n = len(offsets) - 1
    hashes = span_hashes(low, starts, ends)
    counts = np.bincount(doc, minlength=n)
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    of = np.repeat(np.arange(n), shingles)
    head = np.arange(len(of)) + np.repeat(np.cumsum(counts) - counts - (np.cumsum(shingles) - shingles), shingles)
    length = np.minimum(counts, size)[of]
    out = np.zeros(len(of), np.uint64)
    for k in range(size):
        live = np.flatnonzero(length > k)
        out[live] = mixed(out[live] * np.uint64(3) + hashes[head[live] + k])
    order = np.lexsort((out, of))
    out, of = out[order], of[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (of[1:] != of[:-1])
    return out[new], np.bincount(of[new], minlength=n)


def sketch(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key of each set, 0 for the empty one, and the band keys of the sets that are not empty."""
    keys = np.zeros(len(sizes), np.uint64)
    held = np.flatnonzero(sizes)
    bands = np.zeros((len(held), BANDS), np.uint64)
    if len(held):
        begin = (np.cumsum(sizes) - sizes)[held]
        keys[held] = mixed(np.add.reduceat(mixed(hashes), begin) + sizes[held].astype(np.uint64))
        for k in range(BANDS * MINIMA):
            least = np.minimum.reduceat(hashes * _FACTORS[k] + _ADDED[k], begin)
            bands[:, k // MINIMA] = mixed(bands[:, k // MINIMA] + least + np.uint64(k))
    return keys, bands


def sketches(rows: DataFrame) -> DataFrame:
    """``(row, id, key, bands)`` of rows ``(row, id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(2)):
                hashes, sizes = shingle_sets(data, offsets)
                keys, bands = sketch(hashes, sizes)
                places = np.append(0, np.cumsum(np.where(sizes > 0, BANDS, 0))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(first, last - first) for k in (0, 1)),
                        pa.array(keys.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(places), pa.array(bands.ravel().view(np.int64))),
                    ],
                    ["row", "id", "key", "bands"],
                )

    row, kind = (rows.schema[c].dataType.simpleString() for c in ("row", "id"))
    return rows.mapInArrow(run, f"row {row}, id {kind}, key long, bands array<long>")


def sets(texts: DataFrame) -> DataFrame:
    """``(key, hashes)`` of rows ``(key, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(1)):
                hashes, sizes = shingle_sets(data, offsets)
                places = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.ListArray.from_arrays(places, pa.array(hashes.view(np.int64)))],
                    ["key", "hashes"],
                )

    return texts.mapInArrow(run, "key long, hashes array<long>")


def forest(members: list[np.ndarray], left: int) -> list[tuple[int, int]]:
    """Links of a spanning forest over the similar pairs: of all sets, or of the first ``left`` with the others if there are others."""
    sizes = np.array([len(m) for m in members])
    flat = np.concatenate(members)
    begin = np.cumsum(sizes) - sizes
    label = np.arange(len(members))
    out = []
    for i in range(left):
        low = i + 1 if left == len(members) else left
        others = low + np.flatnonzero(label[low:] != label[i])
        a, b = sizes[i], sizes[others]
        others = others[DENOMINATOR * np.minimum(a, b) >= NUMERATOR * np.maximum(a, b)]
        if not len(others):
            continue
        b = sizes[others]
        starts = np.cumsum(b) - b
        values = flat[np.arange(b.sum()) + np.repeat(begin[others] - starts, b)]
        at = np.minimum(np.searchsorted(members[i], values), a - 1)
        shared = np.add.reduceat((members[i][at] == values).astype(np.int64), starts)
        near = others[DENOMINATOR * shared >= NUMERATOR * (a + b - shared)]
        for j in near.tolist():
            if label[j] != label[i]:
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def links(firsts: DataFrame, texts: DataFrame, block: int = BLOCK, classes: DataFrame | None = None) -> DataFrame:
    """``(a, b)`` keys of similar sets; all others are reachable over these. ``firsts`` has ``(key, row, bands)`` of each
    distinct set and ``texts`` the ``(row, text)``. ``classes`` has ``(key, class)`` of fingerprints, whose members are compared like those of a band."""
    bands = firsts.select("key", F.explode("bands").alias("band"))
    if classes is not None:
        # lists that fell together by their number would be compared as one, which loses nothing
        bands = bands.unionByName(classes.select("key", F.xxhash64(F.lit("class"), "class").alias("band")).distinct())
    lists = bands.groupBy("band").agg(
        F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"), F.bit_xor(F.xxhash64("key")).alias("all")
    )
    lists = lists.where("n > 1").groupBy("n", "low", "high", "all").agg(F.min("band").alias("band"))
    lists = lists.select("band", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    members = materialize(bands.join(lists, "band"), "band-members")
    wanted = firsts.select("key", "row").join(members.select("key").distinct(), "key", "left_semi")
    held = materialize(sets(texts.join(wanted, "row").select("key", "text")), "shingle-sets")
    own = F.expr("cast(pmod(xxhash64(key), blocks) as int)")
    sides = F.expr("transform(sequence(0, blocks - 1), o -> struct(least(o, own) as i, greatest(o, own) as j))")
    grid = members.withColumn("own", own).select("band", "own", "key", F.explode(sides).alias("g"))
    flat = grid.select("band", F.col("g.i").alias("i"), F.col("g.j").alias("j"), "own", "key").join(held, "key")

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["own", "key"])
        names = group["key"].to_numpy()
        left = int((group["own"] == key[1]).sum())
        members = [np.asarray(h, np.int64).view(np.uint64) for h in group["hashes"]]
        pairs = np.array(forest(members, left) if left else [], np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": names[pairs[:, 0]], "b": names[pairs[:, 1]]})

    return flat.groupBy("band", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def numbered(docs: DataFrame) -> tuple[str, DataFrame]:
    """The name of an added column that tells rows apart, which no column of ``docs`` has, and ``docs`` with it.

    Rows read from Parquet files are known by file and place and need no copy; other rows are written with numbers once.
    """
    name = "row"
    while name in (c.lower() for c in docs.columns):
        name = f"_{name}"
    try:
        return name, docs.withColumn(
            name, F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
        )
    except AnalysisException:
        number = F.struct(F.lit(0).cast("bigint").alias("file"), F.monotonically_increasing_id().alias("place"))
        return name, materialize(docs.withColumn(name, number), "numbered-rows")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates with all its columns: that of the smallest id.

    The texts go through the fingerprints of :func:`souk.llm.simhash.near_duplicates` first, and its classes and the bands are compared.
    A group are the texts reachable over similarities of 0.8 or more; texts with equal sets, among them nulls and blanks, are
    one group. A null id comes after all others, so that a row without an id stays if no row with one is in its
    group. Of rows with the same id in a group, repeated ones too, one stays. An empty table gives no rows.
    """
    row, rows = numbered(docs)
    found = sketches(rows.select(F.col(row).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("best")
    found = materialize(found, "sketches")
    classes = simhash.near_duplicates(rows.select(row, text_col), row, text_col, SIZE)
    classes = found.select("row", "key").join(classes.select(F.col("doc_id").alias("row"), F.col("component_id").alias("class")), "row")
    classes = classes.select("key", "class").where("key <> 0")  # texts without a word are one set
    firsts = materialize(found.groupBy("key").agg(best, F.first("bands").alias("bands")), "distinct-sets")
    texts = rows.select(F.col(row).alias("row"), F.col(text_col).alias("text"))
    joined = components(links(firsts.select("key", "best.row", "bands"), texts, classes=classes))
    member = firsts.join(joined, firsts["key"] == joined["node"], "left")
    kept = member.groupBy(F.coalesce("component", "key").alias("root")).agg(F.min("best").alias("best"))
    return rows.join(kept.select(F.col("best.row").alias(row)), row, "left_semi").select(*docs.columns)
