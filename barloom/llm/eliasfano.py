"""Elias-Fano coding of a non-decreasing sequence, with select by samples.

``n`` values below ``2**63`` take ``n * (2 + log2(range / n))`` bits: the low bits of each
value are packed, the high bits become a bit vector in which value ``i`` is the ``i``-th
one. ``select(i)`` starts at the sample before ``i`` and counts bits from there, so
neither reading all values nor one needs a table of 64-bit offsets.

Layout, little-endian: ``n, base, low_bits, low_bytes, high_bytes`` (five 64-bit words),
samples (32-bit, one per ``SAMPLE`` values), low bits, high bits.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 256
_HEAD = 5 * 8
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


def encode(values: np.ndarray) -> bytes:
    values = np.asarray(values, np.int64)
    n = len(values)
    base = int(values[0]) if n else 0
    rest = (values - base).astype(np.uint64)
    spread = int(rest[-1]) if n else 0
    low_bits = max(0, (spread // n).bit_length() - 1) if n else 0
    lows = (rest[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
    low = np.packbits(lows.astype(np.uint8).ravel(), bitorder="little").tobytes()
    ones = (rest >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    bits[ones] = 1
    high = np.packbits(bits, bitorder="little").tobytes()
    head = np.array([n, base, low_bits, len(low), len(high)], "<i8").tobytes()
    return head + ones[::SAMPLE].astype("<u4").tobytes() + low + high


class EliasFano:
    """Reads a coded sequence in place; ``size`` is its length in bytes."""

    def __init__(self, data: memoryview):
        self.n, self.base, self.low_bits, low, high = (int(x) for x in np.frombuffer(data, "<i8", 5))
        samples = -(-self.n // SAMPLE)
        at = _HEAD + 4 * samples
        self.samples = np.frombuffer(data, "<u4", samples, _HEAD)
        self.low = np.frombuffer(data, np.uint8, low, at)
        self.high = np.frombuffer(data, np.uint8, high, at + low)
        self.size = at + low + high

    def _low(self, first: int, count: int) -> np.ndarray:
        start, stop = first * self.low_bits, (first + count) * self.low_bits
        bits = np.unpackbits(self.low[start // 8 : -(-stop // 8)], bitorder="little")
        bits = bits[start % 8 : start % 8 + stop - start].reshape(count, self.low_bits).astype(np.int64)
        return bits @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        return self.base + ((ones - np.arange(self.n)) << self.low_bits) + self._low(0, self.n)

    def select(self, i: int) -> int:
        """Value ``i`` (from 0)."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = at // 8
        bits = int(self.high[byte]) >> (at % 8) << (at % 8)
        while (ones := int(_ONES[bits])) <= left:
            left -= ones
            byte += 1
            bits = int(self.high[byte])
        for _ in range(left):
            bits &= bits - 1
        one = byte * 8 + (bits & -bits).bit_length() - 1
        return self.base + ((one - i) << self.low_bits) + int(self._low(i, 1)[0])
