"""A minimal perfect hash for 128-bit keys, built and probed with numpy.

Keys are thrown into a bit array about as long as their number. Those alone in their slot keep it, the others go on to the
next, shorter level. The place of a key is the number of set bits before its own, so n keys get the places 0 to n - 1 at
about three bits a key. A key that was never built in finds no slot or one of another key; its fingerprint tells.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SPREAD = 1.5
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def _slots(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * int(_STEP) % 2**64)
    return (mix64(lo + seed * (hi | np.uint64(1))) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    sizes: np.ndarray
    words: np.ndarray
    ranks: np.ndarray

    @classmethod
    def build(cls, hi: np.ndarray, lo: np.ndarray) -> PerfectHash:
        """`hi` and `lo` are uint64 halves of distinct keys."""
        sizes, parts = [], []
        while len(hi):
            size = max(64, -(-int(len(hi) * SPREAD) // 64) * 64)
            slots = _slots(hi, lo, len(sizes), size)
            alone = np.bincount(slots, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            again = ~alone[slots]
            hi, lo = hi[again], lo[again]
        words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        counts = np.bitwise_count(words).astype(np.int64)
        return cls(np.array(sizes, np.int64), words, (np.cumsum(counts) - counts).astype(np.uint32))

    def places(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The place of every key, -1 where no slot is found."""
        found = np.full(len(hi), -1, np.int64)
        left, start = np.arange(len(hi)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = start + _slots(hi[left], lo[left], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            found[left[hit]] = self.ranks[at[hit] >> 6].astype(np.int64) + below[hit]
            left, start = left[~hit], start + size
        return found
