"""Periodic runs of words by Lyndon roots, and texts with their repetitions collapsed.

A run is a maximal stretch with a smallest period. Every run contains a Lyndon root: the longest Lyndon word
at some position, under an order of the words or under the opposite order. Baier's grouping, the first phase of his suffix sorter, ends
with each suffix in the group of its longest Lyndon prefix, which gives the Lyndon array of either order directly. Each
root is extended to both sides by longest common extensions.

Only stretches that can hold a run long enough are grouped. A run of ``n`` words with period ``q``, ``n >= 24`` and
``n >= 3 q``, has ``n - 7 >= 2 q`` windows of eight words, so each of them stands there at least twice, ``q`` apart. Runs
therefore lie within unbroken series of windows that the text has more than once; all other words are in no run.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from souk.llm.arrays import mixed, span_hashes, text_slices, words

#: A run has at least this many words, and this many times its period.
MIN_WORDS, MIN_PERIODS = 24, 3
#: Words of a window; two thirds of MIN_WORDS are left when its words but one are taken off.
WINDOW = 8


def lyndon_array(symbols: list[int]) -> list[int]:
    """The length of the longest Lyndon word that starts at each position, by Baier's grouping.

    Groups hold suffixes that begin with the same word; there is one for each symbol at first. From the highest group down,
    each member looks for its nearest position to the left in a lower group. Positions that are looked up ``k`` times
    move from their group to a new one right above it, whose word has gained ``k`` copies of the processed word.
    """
    n = len(symbols)
    values = sorted(set(symbols))
    rank = {v: k for k, v in enumerate(values)}
    group = [rank[v] for v in symbols]
    members: list[list[int]] = [[] for _ in values]
    for i, g in enumerate(group):
        members[g].append(i)
    length = [1] * len(values)
    below = list(range(-1, len(values) - 1))
    above = [*range(1, len(values)), -1]
    left = list(range(-1, n - 1))  # of a processed position: one further left, on the way to the nearest open one
    closed = bytearray(n)
    out = [0] * n
    at = len(values) - 1
    while at >= 0:
        word = length[at]
        inside = [i for i in members[at] if group[i] == at]
        members[at] = []
        for i in inside:
            closed[i] = 1
            out[i] = word
        looked: dict[int, int] = {}
        for i in inside:
            j = left[i]
            if j >= 0 and closed[j]:
                k = left[j]
                while k >= 0 and closed[k]:
                    left[j] = left[k]  # halve the path
                    j = k
                    k = left[k]
                j = k
                left[i] = j
            if j >= 0:
                looked[j] = looked.get(j, 0) + 1
        if looked:
            moves: dict[tuple[int, int], list[int]] = {}
            for j, times in looked.items():
                moves.setdefault((times, group[j]), []).append(j)
            for times, low in sorted(moves, reverse=True) if len(moves) > 1 else moves:
                moved = moves[times, low]
                new = len(length)
                length.append(length[low] + times * word)
                members.append(moved)
                high = above[low]
                below.append(low)
                above.append(high)
                above[low] = new
                below[high] = new  # there is one: the group in work is above ``low``
                for j in moved:
                    group[j] = new
        at = below[at]
    return out


class Extensions:
    """Longest common extensions of pairs of positions a period apart, by prefix hashes; for many pairs at a time."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        rate = np.uint64(0x9E3779B97F4A7C15)
        self.powers = np.ones(self.n + 1, np.uint64)
        np.multiply.accumulate(np.full(self.n, rate), out=self.powers[1:])
        values = mixed(symbols.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(values * self.powers[: self.n], out=self.sums[1:])

    def _same(self, a: np.ndarray, period: np.ndarray, size: int) -> np.ndarray:
        b = a + period
        return (self.sums[a + size] - self.sums[a]) * self.powers[period] == self.sums[b + size] - self.sums[b]

    def right(self, a: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those from ``a + period`` on."""
        out, room = np.zeros(len(a), np.int64), self.n - a - period
        for k in reversed(range(self.n.bit_length())):
            fits = np.flatnonzero(room - out >= 1 << k)
            out[fits[self._same(a[fits] + out[fits], period[fits], 1 << k)]] += 1 << k
        return out

    def left(self, a: np.ndarray, period: np.ndarray) -> np.ndarray:
        """How many words before ``a`` equal those before ``a + period``."""
        out = np.zeros(len(a), np.int64)
        for k in reversed(range(self.n.bit_length())):
            fits = np.flatnonzero(a - out >= 1 << k)
            out[fits[self._same(a[fits] - out[fits] - (1 << k), period[fits], 1 << k)]] += 1 << k
        return out


def _around(symbols: np.ndarray, start: int, stop: int, period: int, roots: np.ndarray) -> set[tuple[int, int]]:
    """The runs around roots within a stretch, word by word: one run if the hashes have told all words apart."""
    differs = np.flatnonzero(symbols[start : stop - period] != symbols[start + period : stop]) + start
    if not len(differs):
        return {(start, stop)}
    at = np.searchsorted(differs, roots)
    edges = np.concatenate(([start - 1], differs, [stop - period]))
    return set(zip((edges[at] + 1).tolist(), (edges[at + 1] + period).tolist(), strict=True))


def find_runs(symbols: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs of a sequence, by start and period."""
    n = len(symbols)
    if n < min_words:
        return []
    extensions = Extensions(symbols)
    found: set[tuple[int, int, int]] = set()
    for order in (symbols, -symbols):
        period = np.array(lyndon_array(order.tolist()), np.int64)
        at = np.flatnonzero(period * min_periods <= n)
        period = period[at]
        # a root that no neighbour repeats is no run
        after, before = at + period, at - 1
        goes = (after < n) & (symbols[np.minimum(after, n - 1)] == symbols[at])
        goes |= (before >= 0) & (symbols[np.maximum(before, 0)] == symbols[after - 1])
        at, period = at[goes], period[goes]
        start = at - extensions.left(at, period)
        stop = at + period + extensions.right(at, period)
        wide = np.flatnonzero(stop - start >= np.maximum(min_words, min_periods * period))
        sides = np.stack((start[wide], stop[wide], period[wide]), 1)
        stretches, of = np.unique(sides, axis=0, return_inverse=True)
        by_stretch = np.split(at[wide][np.argsort(of.ravel(), kind="stable")], np.cumsum(np.bincount(of.ravel()))[:-1]) if len(wide) else []
        for (a, b, q), roots in zip(stretches.tolist(), by_stretch, strict=True):
            found |= {(x, y - x, q) for x, y in _around(symbols, a, b, q, roots)}
    return sorted(run for run in found if run[1] >= max(min_words, min_periods * run[2]))


def series(hashes: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and word after the last of each stretch that may hold runs; ``hashes`` are those of the words of a slice."""
    window = hashes
    step = 1
    while step < WINDOW:
        window = mixed(window[:-step] * np.uint64(3) + window[step:])
        step *= 2
    if len(hashes) < WINDOW or not len(window):
        return (np.zeros(0, np.int64),) * 2
    first = np.flatnonzero(doc[: len(window)] == doc[WINDOW - 1 :])
    own = window[first] ^ mixed(doc[first].astype(np.uint64))
    order = np.argsort(own, kind="stable")
    same = own[order[1:]] == own[order[:-1]]
    again = np.zeros(len(hashes) + 1, bool)
    again[first[order[1:][same]]] = True
    again[first[order[:-1][same]]] = True
    # a series ends where a window is not repeated or belongs to the next document
    new_doc = np.flatnonzero(np.diff(doc)) + 1
    border = np.zeros(len(hashes) + 1, bool)
    border[new_doc] = True
    begins = np.flatnonzero(again & (~np.concatenate(([False], again[:-1])) | border))
    ends = np.flatnonzero(again[:-1] & (~again[1:] | border[1:])) + WINDOW
    long = ends - begins >= MIN_WORDS
    return begins[long], ends[long]


def collapsed(words_of: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, joined by blanks."""
    if not runs:
        return b" ".join(words_of)
    kept = np.ones(len(words_of), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words_of[i] for i in np.flatnonzero(kept).tolist()])


def with_runs(docs: DataFrame, text_col: str = "text", runs_col: str = "runs", collapsed_col: str = "collapsed") -> DataFrame:
    """All rows and columns of ``docs`` plus the runs of each text and the text with its runs collapsed to one period each.

    A null or blank text has no runs and an empty collapsed text. Rows are handled one by one, so repeated rows and ids of any
    kind keep their place; an empty table gives no rows. Added columns must have names that ``docs`` lacks.
    """
    for name in (runs_col, collapsed_col):
        if name.lower() in (c.lower() for c in docs.columns):
            raise ValueError(f"the table has a column {name} already")
    at, names = docs.columns.index(text_col), [*docs.columns, runs_col, collapsed_col]
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column(at)):
                begin, end, doc = words(data, offsets)
                hashes = span_hashes(data, begin, end)
                heads = np.searchsorted(doc, np.arange(last - first))
                starts, stops = series(hashes, doc, last - first)
                found: dict[int, list[tuple[int, int, int]]] = {}
                raw = data.tobytes()
                for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                    named: dict[bytes, int] = {}
                    places = zip(begin[a:b].tolist(), end[a:b].tolist(), strict=True)
                    symbols = np.array([named.setdefault(raw[x:y], len(named)) for x, y in places], np.int64)
                    of = int(doc[a])
                    shift = a - int(heads[of])
                    found.setdefault(of, []).extend((s + shift, n, q) for s, n, q in find_runs(symbols))
                texts = [
                    collapsed(raw[x:y].split(), found.get(k, []))
                    for k, (x, y) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
                ]
                runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in found.get(k, ())] for k in range(last - first)]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, last - first) for c in batch.columns), pa.array(runs, kind), pa.array(texts, pa.binary()).cast(pa.string())],
                    names,
                )

    one = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])
    schema = StructType([*docs.schema.fields, StructField(runs_col, ArrayType(one)), StructField(collapsed_col, StringType())])
    return docs.mapInArrow(run, schema)


def periodic(doc_id: Column, text: Column) -> Column:
    """The text of one document in ten made periodic from some word on, after a checksum of its id; the others as they are."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    listed = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def rolled(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        place = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(
            F.transform(place, lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " "
        )

    # each word of the list once; a text without words has nothing to repeat
    made = F.transform(F.array(listed), lambda w: F.when(F.size(w) > 0, rolled(w)))[0]
    return F.when(h % 10 == 0, F.coalesce(made, text)).otherwise(text)
