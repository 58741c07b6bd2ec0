"""Token counts of byte-level BPE by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of many texts lie in one flat array of symbols. In each round every pre-token
merges its own lowest-ranked pair, wherever it stands in it, all at the same time; what is left at
the end are its tokens.
"""

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from souk.llm.arrays import pieces, span_hashes

#: Characters of text whose pre-tokens are counted at once, symbols merged at once, and counts kept in a task.
TEXT_CHARS, MERGED_SYMBOLS, KEPT_COUNTS = 1 << 20, 1 << 18, 1_000_000
NO_RANK = np.iinfo(np.int32).max

# The pre-token pattern of byte-level BPE is
#   's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
# with \s as Unicode's White_Space; these are its contractions.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
SPACE, LETTER, NUMBER, OTHER = range(4)

_classes: list[np.ndarray] = []


def character_classes() -> np.ndarray:
    """The class of each code point."""
    if not _classes:
        table = np.full(0x110000, OTHER, np.uint8)
        for first, last in ((0, 0xD800), (0xE000, 0x110000)):
            text = "".join(map(chr, range(first, last)))
            for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
                for m in regex.finditer(pattern, text):
                    table[first + m.start() : first + m.end()] = kind
        _classes.append(table)
    return _classes[0]


def pre_tokens(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of texts begin; ``points`` has the texts' code points end to end.

    Runs of one class are pre-tokens but for three rules: of white space before something else the last
    character stands alone, or if it is a blank with what follows, and an apostrophe that
    begins a pre-token takes the letters of a contraction.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = character_classes()[points]
    border = np.zeros(n + 1, bool)  # of texts
    border[offsets] = True
    start = border[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last white space of a run, with something after it in the same text
    final = np.zeros(n, bool)
    final[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~border[1:n]
    blank = points == 32
    at = np.flatnonzero(final)
    start[at] = True
    start[at[blank[at]] + 1] = False
    # contractions
    mark = np.flatnonzero((points == 39) & start)
    if len(mark):
        padded = np.concatenate((points, np.zeros(3, points.dtype)))
        ends = np.append(offsets[1:], n)[np.searchsorted(offsets[1:], mark, "right")]
        free = np.ones(len(mark), bool)
        for letters in CONTRACTIONS:
            hit = free & (mark + len(letters) < ends)
            for k, c in enumerate(letters):
                hit &= padded[mark + 1 + k] == ord(c)
            free &= ~hit
            start[mark[hit] + 1] = False
            after = mark[hit] + 1 + len(letters)
            start[after[after < n]] = True
    return np.flatnonzero(start)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Merges by pair of ids, and the strings of special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([(ids[a] << 32) | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)  # by rank
        self.bytes = np.array([ids[c] for c in byte_symbols()], np.int64)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)


def merged_lengths(vocabulary: Vocabulary, words: list[bytes]) -> np.ndarray:
    """Tokens of each pre-token."""
    lengths = np.array([len(w) for w in words], np.int64)
    out = np.zeros(len(words), np.int64)
    symbols = vocabulary.bytes[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), lengths)
    ranks = np.full(len(symbols), NO_RANK, np.int32)  # of the pair that begins here
    inner = np.flatnonzero(owner[:-1] == owner[1:])
    ranks[inner] = vocabulary.rank(symbols[inner], symbols[inner + 1])
    while len(symbols):
        begins = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(begins, append=len(owner))
        lowest = np.minimum.reduceat(ranks, begins)
        done = lowest == NO_RANK
        if done.any():
            out[owner[begins[done]]] = sizes[done]
            going = np.repeat(~done, sizes)
            symbols, owner, ranks = symbols[going], owner[going], ranks[going]
            lowest, sizes = lowest[~done], sizes[~done]
            if not len(symbols):
                break
        hit = ranks == np.repeat(lowest, sizes)
        # of overlapping hits (a a a) every other one, from the left
        places = np.flatnonzero(hit)
        fresh = np.diff(places, prepend=-2) > 1
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
        places = places[(np.arange(len(places)) - run) % 2 == 0]
        symbols[places] = vocabulary.merged[ranks[places]]
        keep = np.ones(len(symbols), bool)
        keep[places + 1] = False
        moved = np.cumsum(keep)[places] - 1
        symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
        for changed in (moved, moved[moved > 0] - 1):
            ranks[changed] = NO_RANK
            pairs = changed[changed + 1 < len(owner)]
            pairs = pairs[owner[pairs] == owner[pairs + 1]]
            ranks[pairs] = vocabulary.rank(symbols[pairs], symbols[pairs + 1])
    return out


class Counter:
    """Counts texts and keeps the counts of pre-tokens by their hashes, in order."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _merge(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        begin = 0
        while begin < len(order):
            end, size = begin, 0
            while end < len(order) and (end == begin or size + len(words[order[end]]) <= MERGED_SYMBOLS):
                size += len(words[order[end]])
                end += 1
            out[order[begin:end]] = merged_lengths(self.vocabulary, [words[i].encode() for i in order[begin:end]])
            begin = end
        return out

    def count(self, texts: list[str]) -> list[int]:
        v = self.vocabulary
        pieces, owner, special = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = v.split.split(text) if v.split and any(s in text for s in v.special) else [text]
            special[i] = len(parts) - 1
            pieces += parts
            owner += [i] * len(parts)
        joined = "".join(pieces)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        offsets = np.cumsum([0, *map(len, pieces)])
        starts = pre_tokens(points, offsets)
        if not len(starts):
            return special.tolist()
        ends = np.append(starts[1:], len(points))
        hashes, first, back = np.unique(span_hashes(points, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        counts = np.zeros(len(hashes), np.int64)
        counts[known] = self.counts[at[known]]
        new = np.flatnonzero(~known)
        counts[new] = self._merge([joined[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
        if len(self.hashes) + len(new) > KEPT_COUNTS:
            self.hashes, self.counts = hashes, counts
        else:
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
            self.counts = np.insert(self.counts, at[new], counts[new])
        texts_of = np.array(owner)[np.searchsorted(offsets, starts, "right") - 1]
        return (special + np.bincount(texts_of, counts[back], len(texts)).astype(np.int64)).tolist()


def token_counts(docs: DataFrame, vocabulary_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text; columns of these names are replaced.

    Counts are those of the vocabulary file's library without begin and end tokens; a special token's string
    in a text is one token. A null or empty text has none. An empty table gives no rows.
    The file must be at the same path on every executor.
    """
    docs = docs.drop("n_bytes", "n_tokens")
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(Vocabulary(vocabulary_path))
        for batch in pieces(batches):
            texts = batch.column(at).fill_null("").to_pylist()
            counts: list[int] = []
            begin = 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end]) <= TEXT_CHARS):
                    size += len(texts[end])
                    end += 1
                counts += counter.count(texts[begin:end])
                begin = end
            sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes, pa.array(counts, pa.int64())], [*names, "n_bytes", "n_tokens"])

    schema = StructType(docs.schema.fields[:]).add("n_bytes", "long").add("n_tokens", "long")
    return docs.mapInArrow(run, schema)


def with_limit(counted: DataFrame, limit: int = 512) -> DataFrame:
    """Marks texts of more than ``limit`` tokens."""
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
