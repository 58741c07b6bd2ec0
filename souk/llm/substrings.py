"""Substring deduplication: content-defined chunks, found again by their digests.

A gear hash over the last sixteen bytes picks the chunk ends among the word starts, so an
insertion moves the ends near it and no others. A chunk whose digest stands in a document with a smaller
id, or earlier in its own, is repeated; runs of repeated chunks of at least ``MIN_WORDS`` words are cut.
"""

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.llm.arrays import pieces, span_hashes, text_slices, words
from souk.llm.names import free, others

#: Bytes of a chunk, least and most; the gear hash at a chunk's end is below END (one in three).
MIN_CHUNK, MAX_CHUNK, END = 16, 256, (1 << 16) // 3
#: Words that a run of repeated chunks needs to be cut.
MIN_WORDS = 20
#: The columns that tell what was cut.
ADDED = ("_cuts", "_cut_words")

_GEAR = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 16, 256, dtype=np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash ``h = 2 h + G[byte]`` in 16 bits at each byte: a window of sixteen bytes."""
    out = _GEAR[data]
    for step in (1, 2, 4, 8):
        longer = out.copy()
        longer[step:] += out[:-step] << step
        out = longer
    return out


def chunk_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document index of the chunks, which cover every document.

    The least length keeps a document's first window from seeing the document before.
    """
    starts, _, _ = words(data, offsets)
    starts = starts[starts > 0]
    ends = starts[gear(data)[starts - 1] < END].tolist() if len(starts) else []
    begin, finish, doc = [], [], []
    at, total = 0, len(ends)
    for d, (pos, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        while pos < end:
            at = bisect_left(ends, pos + MIN_CHUNK, at)
            to = ends[at] if at < total else end
            if to > pos + MAX_CHUNK:
                to = pos + MAX_CHUNK
                while to < end and data[to] & 0xC0 == 0x80:  # not inside a character
                    to += 1
            to = min(to, end)
            begin.append(pos)
            finish.append(to)
            doc.append(d)
            pos = to
    return np.array(begin, np.int64), np.array(finish, np.int64), np.array(doc, np.int64)


def chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(digest, doc_id, start, stop, again)``: every chunk and its bytes' place.

    A digest of 64 bits is enough, as only runs of several chunks are cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(1)):
                start, stop, doc = chunk_bounds(data, offsets)
                digest = span_hashes(data, start, stop)
                order = np.lexsort((digest, doc))  # stable: the first place of a chunk comes first
                again = np.zeros(len(start), bool)
                again[order[1:]] = (np.diff(digest[order].view(np.int64)) == 0) & (np.diff(doc[order]) == 0)
                place = offsets[doc]
                ids = batch.column(0).slice(first, last - first).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest.view(np.int64)), ids]
                    + [pa.array((x - place).astype(np.int32)) for x in (start, stop)]
                    + [pa.array(again)],
                    ["digest", "doc_id", "start", "stop", "again"],
                )

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"digest long, doc_id {kind}, start int, stop int, again boolean"
    return docs.select(F.col(id_col), F.col(text_col)).where(F.col(id_col).isNotNull()).mapInArrow(run, schema)


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start, stop, digest)``: chunks that stand earlier in id order or earlier in their text."""
    found = chunks(docs, id_col, text_col)
    fresh = found.where("not again")
    owners = fresh.groupBy("digest").agg(F.min("doc_id").alias("owner"), F.count("*").alias("n")).where("n > 1")
    later = fresh.join(owners.drop("n"), "digest").where("doc_id > owner")
    place = ["doc_id", "start", "stop", "digest"]
    return later.select(place).union(found.where("again").select(place))


def cut(text: bytes, spans: list[tuple[int, int, int]], min_words: int) -> tuple[bytes, int, int]:
    """The text without its long runs of repeated chunks, the runs cut and their words.

    A span whose bytes do not have the hash belongs to another row with the same id and is left.
    """
    if not spans:
        return text, 0, 0
    data = np.frombuffer(text, np.uint8)
    fits = [(a, b) for a, b, _ in spans if b <= len(data)]
    hashes = span_hashes(data, np.array([a for a, _ in fits], np.int64), np.array([b for _, b in fits], np.int64))
    known = {(a, b, h) for a, b, h in spans}
    fits = sorted((a, b) for (a, b), h in zip(fits, hashes.view(np.int64).tolist(), strict=True) if (a, b, h) in known)
    runs: list[list[int]] = []
    for a, b in fits:
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(b, runs[-1][1])
        else:
            runs.append([a, b])
    kept, pos, cuts, gone = [], 0, 0, 0
    for a, b in runs:
        n = len(text[a:b].split())
        if n >= min_words:
            kept.append(text[pos:a])
            pos, cuts, gone = b, cuts + 1, gone + n
    kept.append(text[pos:])
    return b"".join(kept), cuts, gone


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with repeated passages cut out of the text column, plus ``_cuts`` and ``_cut_words``; columns of these names are replaced.

    The first place of a passage in id order stays whole. All rows and columns are kept; a null text
    stays null, a text that is repeated throughout becomes empty, rows with one id count as one
    document and rows without an id stay as they are. An empty table gives no rows.
    """
    docs = docs.select(*others(docs.columns, ADDED))
    of, held_spans = free("_of", docs.columns), free("_spans", docs.columns)
    spans = repeated_chunks(docs, id_col, text_col).groupBy(F.col("doc_id").alias(of)).agg(
        F.collect_set(F.struct("start", "stop", "digest")).alias(held_spans)
    )
    joined = docs.join(spans, F.col(id_col) == F.col(of), "left").drop(of)
    names, kept_names = joined.columns, docs.columns
    at, spans_at = names.index(text_col), names.index(held_spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            held = batch.column(spans_at)
            texts, cuts, gone = batch.column(at), np.zeros(len(batch), np.int32), np.zeros(len(batch), np.int32)
            touched = np.flatnonzero(held.is_valid().to_numpy(zero_copy_only=False) & texts.is_valid().to_numpy(zero_copy_only=False))
            if len(touched):
                new = texts.to_pylist()
                for row in touched.tolist():
                    spans = [(s["start"], s["stop"], s["digest"]) for s in held[row].as_py()]
                    out, cuts[row], gone[row] = cut(new[row].encode(), spans, min_words)
                    new[row] = out.decode()
                texts = pa.array(new, texts.type)
            columns = [texts if k == at else batch.column(k) for k in range(len(names)) if k != spans_at]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(cuts), pa.array(gone)], [*kept_names, *ADDED]
            )

    schema = StructType(docs.schema.fields[:])
    for name in ADDED:
        schema = schema.add(name, "integer")
    return joined.mapInArrow(run, schema)
