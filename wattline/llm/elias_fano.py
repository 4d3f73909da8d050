"""Elias-Fano lists: non-decreasing integers in about 2 + log2(largest / number) bits each, with direct access."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: One position is kept for so many set bits; between two of them at most this many bits are counted.
SAMPLE = 256


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    spread = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little")


@dataclass
class EliasFano:
    """`low` holds the `bits` lower bits of each value side by side; in `high` the bit (value >> bits) + i is set."""

    n: int
    bits: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        places = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(places[-1]) + 8) // 8 if n else 0, np.uint8)
        np.bitwise_or.at(high, places >> 3, (1 << (places & 7)).astype(np.uint8))
        return cls(n, bits, _pack(values, bits), high, places[::SAMPLE].astype(np.uint32))

    def _low(self, i: int) -> int:
        first, last = i * self.bits, (i + 1) * self.bits
        word = int.from_bytes(self.low[first >> 3 : (last + 7) >> 3].tobytes(), "little")
        return word >> (first & 7) & ((1 << self.bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value, from the nearest sample onward."""
        place = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, place >> 3
        word = int(self.high[byte]) >> (place & 7) << (place & 7)
        while word.bit_count() <= left:
            left -= word.bit_count()
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        place = (byte << 3) + (word & -word).bit_length() - 1
        return (place - i) << self.bits | self._low(i)

    def decode(self) -> np.ndarray:
        """All values at once."""
        if not self.n:
            return np.zeros(0, np.int64)
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        lows = np.unpackbits(self.low, bitorder="little")[: self.n * self.bits].reshape(self.n, self.bits)
        low = (lows.astype(np.int64) << np.arange(self.bits)).sum(axis=1) if self.bits else 0
        return (places - np.arange(self.n)) << self.bits | low

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.bits, len(self.low), len(self.high), len(self.samples)], "<u8")
        return b"".join(x.tobytes() for x in (head, self.low, self.high, self.samples.astype("<u4")))

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[EliasFano, memoryview]:
        """The list at the start of `data` and what follows it."""
        n, bits, low, high, samples = (int(x) for x in np.frombuffer(data[:40], "<u8"))
        a, b, c = 40 + low, 40 + low + high, 40 + low + high + 4 * samples
        parts = np.frombuffer(data[40:a], np.uint8), np.frombuffer(data[a:b], np.uint8), np.frombuffer(data[b:c], "<u4")
        return cls(n, bits, *parts), data[c:]
