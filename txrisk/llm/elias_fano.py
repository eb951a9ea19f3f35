"""Elias-Fano coding of a non-decreasing integer sequence, with a select structure.

Each value is split into ``low_bits`` low bits, kept packed, and a high part, kept in unary:
bit ``(value >> low_bits) + i`` of the high array is set for element ``i``. The select
structure keeps the position of every 256th set bit as 32 bits; an element is found from
there by counting bits. About ``2 + log2(max / n)`` bits an element, 1/8 bit for select.
"""

from __future__ import annotations

import numpy as np

STEP = 256


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = v.size
        if n == 0:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, "<u4"))
        if n > 1 and (v[1:] < v[:-1]).any():
            raise ValueError("the sequence must not decrease")
        low_bits = max(0, (int(v[-1]) // n).bit_length() - 1)
        bits = (v[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(ones[-1]) >> 3) + 1, np.uint8)
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        return cls(n, low_bits, low, high, ones[::STEP].astype("<u4"))

    def _low(self, a: int, b: int) -> np.ndarray:
        """The low parts of elements a to b, from their bytes alone."""
        first = a * self.low_bits
        bits = np.unpackbits(self.low[first >> 3 : (b * self.low_bits + 7) >> 3], bitorder="little")
        bits = bits[first & 7 :][: (b - a) * self.low_bits].reshape(b - a, self.low_bits)
        return (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def select(self, i: int) -> int:
        """Position of the i-th set bit of the high array, from the nearest sample before it."""
        at, need = int(self.samples[i // STEP]), i % STEP
        byte, skip = at >> 3, at & 7
        word = int(self.high[byte]) >> skip << skip
        while (c := word.bit_count()) <= need:
            need -= c
            byte += 1
            word = int(self.high[byte])
        for _ in range(need):
            word &= word - 1
        return (byte << 3) + (word & -word).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        first = i * self.low_bits
        part = self.low[first >> 3 : ((first + self.low_bits) >> 3) + 1].tobytes()
        low = int.from_bytes(part, "little") >> (first & 7) & ((1 << self.low_bits) - 1)
        return (self.select(i) - i << self.low_bits) | low

    def values(self, a: int, b: int) -> np.ndarray:
        """Elements a to b: the high array is read between their two selected bits only."""
        if not 0 <= a <= b <= self.n:
            raise IndexError((a, b))
        if a == b:
            return np.zeros(0, np.int64)
        first, last = self.select(a), self.select(b - 1)
        bits = np.unpackbits(self.high[first >> 3 : (last >> 3) + 1], bitorder="little")
        ones = np.flatnonzero(bits[first & 7 :])[: b - a] + first
        high = ones - np.arange(a, b)
        return (high << self.low_bits) | (self._low(a, b) if self.low_bits else 0)

    def decode(self) -> np.ndarray:
        """All values."""
        return self.values(0, self.n)

    def last_at_most(self, value: int, a: int) -> int:
        """The last element from a on that is at most ``value`` (a itself at least), by
        selects: steps that double, then halve."""
        step = 1
        while a + step < self.n and self[a + step] <= value:
            a += step
            step *= 2
        while step:
            if a + step < self.n and self[a + step] <= value:
                a += step
            step //= 2
        return a

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, self.low.size, self.high.size, self.samples.size], "<u8")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        n, low_bits, a, b, c = (int(x) for x in np.frombuffer(raw, "<u8", 5))
        at = 40
        low = np.frombuffer(raw, np.uint8, a, at)
        high = np.frombuffer(raw, np.uint8, b, at + a)
        return cls(n, low_bits, low, high, np.frombuffer(raw, "<u4", c, at + a + b))
