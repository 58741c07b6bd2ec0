"""Byte-array helpers shared by the text operators: slices of Arrow text columns, words, word hashes.

Tasks get texts as Arrow batches; here they become one ``uint8`` array with document
offsets, so that words, hashes and sums are computed for megabytes of text at a time.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer document is a slice of its own.
SLICE_BYTES = 1 << 20

#: Rows of an Arrow batch that a task turns into Python objects at once.
PIECE_ROWS = 1024

#: The white space of a word pattern [^\x20\x09-\x0D]+.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes with A-Z as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RATE = np.uint64(0x9E3779B97F4A7C15 | 1)
_RATE_BACK = np.uint64(pow(int(_RATE), -1, 1 << 64))
_BYTE_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def pieces(batches: Iterator[pa.RecordBatch], rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows."""
    for batch in batches:
        for first in range(0, len(batch), rows):
            yield batch.slice(first, rows)


def text_slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row after the last, bytes, offsets)`` of consecutive rows; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    rows = len(texts)
    if not rows:
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + rows + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + size, "right")) - 1)
        yield first, last, raw[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document index of each word; a word never spans two documents."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = ~SPACES[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = np.flatnonzero(np.diff(offsets))
    opens[offsets[filled]] = inside[offsets[filled]]
    closes[offsets[filled + 1] - 1] = inside[offsets[filled + 1] - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _power(kind: str, rate: np.uint64, count: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < count:
        steps = np.full(max(count, SLICE_BYTES + 1), rate)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if count <= 4 * SLICE_BYTES:
            _powers[kind] = have
    return have


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes, or code points, of each span, the same wherever the span stands.

    Sums of byte values times powers of an odd rate, taken as differences of a
    running sum and shifted back to power zero; the length goes into the mix.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    values = _BYTE_VALUES[data] if data.dtype == np.uint8 else mixed(data.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    np.cumsum(values * _power("on", _RATE, len(data))[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power("back", _RATE_BACK, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))

