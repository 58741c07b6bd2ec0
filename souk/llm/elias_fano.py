"""Elias-Fano coding of non-decreasing numbers: near-minimal space, any one of them read without the others.

Of ``n`` numbers up to ``u`` each keeps its ``l = log2(u / n)`` low bits in a packed array. The high parts stand in unary in
a bit vector: number ``i`` with high part ``h`` sets bit ``h + i``, so the place of the ``i``-th set bit gives it back. A
directory holds the place of every ``SAMPLE``-th set bit in 32 bits; a select starts there and counts bits of whole bytes.
"""

import struct

import numpy as np

#: Set bits between two entries of the select directory.
SAMPLE = 256

_HEAD = struct.Struct("<QQIIQ")  # numbers, largest, low bits, directory entries, bytes of the high part
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def encode(values: np.ndarray) -> bytes:
    """The code of non-decreasing numbers of 0 or more; of no numbers too."""
    values = np.asarray(values, np.int64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    bits = (values[:, None] >> np.arange(low)) & 1
    high = np.zeros((top >> low) + n + 1, bool)
    places = (values >> low) + np.arange(n)
    high[places] = True
    packed = np.packbits(high, bitorder="little")
    directory = places[::SAMPLE].astype("<u4")
    head = _HEAD.pack(n, top, low, len(directory), len(packed))
    lows = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
    return head + directory.tobytes() + packed.tobytes() + lows.tobytes()


class EliasFano:
    """The numbers of a code that begins at ``start`` of ``data``, which may be bytes or a memory map."""

    def __init__(self, data, start: int = 0):
        data = np.frombuffer(data, np.uint8) if isinstance(data, (bytes, memoryview)) else data
        self.n, self.top, self.low, entries, high = _HEAD.unpack(data[start : start + _HEAD.size].tobytes())
        at = start + _HEAD.size
        self.directory = data[at : at + 4 * entries].view("<u4")
        at += 4 * entries
        self.high = data[at : at + high]
        at += high
        self.lows = data[at : at + (self.n * self.low + 7) // 8]
        self.stop = at + len(self.lows)

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        """The place of the ``i``-th set bit of the high part, counted from 0."""
        place = int(self.directory[i // SAMPLE])
        left = i % SAMPLE  # set bits still to pass
        byte, first = place // 8, int(self.high[place // 8]) & (0xFF << place % 8) & 0xFF
        while True:
            window = self.high[byte : byte + SAMPLE].copy()
            window[0] = first
            passed = np.cumsum(_ONES[window], dtype=np.int64)
            k = int(np.searchsorted(passed, left, "right"))
            if k < len(window):
                left -= int(passed[k - 1]) if k else 0
                inside = np.flatnonzero(np.unpackbits(window[k : k + 1], bitorder="little"))
                return 8 * (byte + k) + int(inside[left])
            left -= int(passed[-1])
            byte += len(window)
            first = int(self.high[byte])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        high = self.select(i) - i
        if not self.low:
            return high
        bit = i * self.low
        raw = int.from_bytes(self.lows[bit // 8 : (bit + self.low + 7) // 8].tobytes(), "little")
        return high << self.low | raw >> bit % 8 & (1 << self.low) - 1

    def all(self) -> np.ndarray:
        """Every number."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        values = (places - np.arange(self.n)) << self.low
        if self.low:
            bits = np.unpackbits(self.lows, count=self.n * self.low, bitorder="little").reshape(self.n, self.low)
            values |= bits.astype(np.int64) @ (1 << np.arange(self.low, dtype=np.int64))
        return values

    def up_to(self, value: int) -> int:
        """How many numbers are at most ``value``; a binary search by selects."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            if self[middle] <= value:
                low = middle + 1
            else:
                high = middle
        return low
