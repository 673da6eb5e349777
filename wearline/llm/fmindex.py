"""A compressed full-text index over whole numbers: BWT in a wavelet matrix, backward search.

The wavelet matrix holds one bit per symbol and level, packed in words of 64, with a count per
word; rank is a table look-up and a population count. Many patterns are searched together: each
step narrows all their suffix intervals by one symbol to the left.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their suffixes, compared to ``depth`` symbols at least; suffixes
    that agree so far keep the order of their places."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    known = 1
    while True:
        later = np.zeros(n, np.int64)
        later[: max(0, n - known)] = rank[known:]
        keys = rank * (n + 2) + later
        order = np.argsort(keys, kind="stable")
        if known * 2 >= depth:
            return order
        new = np.append(0, keys[order][1:] != keys[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new) + 1
        if rank[order[-1]] == n:
            return order
        known *= 2


class WaveletMatrix:
    """Ranks of symbols below ``2 ** levels`` in prefixes of a sequence."""

    def __init__(self, values: np.ndarray, levels: int):
        self.levels = levels
        self.bits, self.before, self.zeros = [], [], []
        for level in reversed(range(levels)):
            bit = (values >> level & 1).astype(np.uint8)
            padded = np.zeros((len(bit) // 64 + 1) * 64, np.uint8)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            self.bits.append(words)
            counts = np.bitwise_count(words).astype(np.int64)
            self.before.append(np.cumsum(counts) - counts)
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones of a level before the places ``at``."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.bits[level][word] & mask)

    def mapped(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the prefix ``at`` ends in the last level's run of each symbol."""
        for level in range(self.levels):
            one = self.ones(level, at)
            bit = symbols >> (self.levels - 1 - level) & 1
            at = np.where(bit == 1, self.zeros[level] + one, at - one)
        return at


class FmIndex:
    """Index of a text of positive whole numbers. Patterns longer than ``depth`` are not
    supported, as the suffixes are sorted to that depth."""

    def __init__(self, text: np.ndarray, depth: int):
        text = text.astype(np.int64)
        self.text, self.depth = text, depth
        self.order = suffix_array(np.append(text, 0), depth + 1)
        levels = max(1, int(text.max(initial=0)).bit_length())
        bwt = np.append(text, 0)[self.order - 1]
        self.matrix = WaveletMatrix(bwt, levels)
        counts = np.bincount(bwt, minlength=(1 << levels) + 1)
        self.smaller = np.cumsum(counts) - counts
        # Where each symbol's run begins on the last level.
        every = np.arange(1 << levels)
        self.run = self.matrix.mapped(every, np.zeros(len(every), np.int64))

    def step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of ``symbol + pattern`` from those of the patterns."""
        base = self.smaller[symbols] - self.run[symbols]
        return base + self.matrix.mapped(symbols, low), base + self.matrix.mapped(symbols, high)

    def all(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of ``count`` empty patterns."""
        return np.zeros(count, np.int64), np.full(count, len(self.order), np.int64)
