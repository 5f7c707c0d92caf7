"""A small FM-index over symbol sequences: suffix order, wavelet ranks, sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. Zeros are separators: each sorts before all symbols, and apart from the others."""
    n = len(text)
    marks = text == 0
    rank = np.where(marks, np.cumsum(marks) - 1, text.astype(np.int64) + int(marks.sum()))
    k = 1
    while True:
        later = np.zeros(n, np.int64)
        later[: n - k] = rank[k:] + 1
        key = rank * (max(n, int(rank.max())) + 2) + later
        order = np.argsort(key, kind="stable")
        steps = np.empty(n, np.int64)
        steps[0] = 0
        steps[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(steps)
        if rank[order[-1]] == n - 1:
            return order
        k *= 2


class WaveletRanks:
    """How often a symbol occurs before a place, by one bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, highest: int):
        self.bits = max(1, int(highest).bit_length())
        self.ones, self.zeros = [], []
        for b in range(self.bits - 1, -1, -1):
            bit = (symbols >> b) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(len(symbols) - int(self.ones[-1][-1]))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))
        every = np.arange(highest + 1)
        self.base = self._down(every, np.zeros(highest + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.bits):
            ones = self.ones[level][at]
            at = np.where((symbol >> (self.bits - 1 - level)) & 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(symbol, at) - self.base[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and its rank there."""
        symbol = np.zeros(len(at), np.int64)
        for level in range(self.bits):
            ones = self.ones[level][at]
            bit = self.ones[level][at + 1] - ones
            symbol = symbol * 2 + bit
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return symbol, at - self.base[symbol]


class FMIndex:
    """Counts and locates patterns in runs of symbols 1..highest that zeros set apart.

    The text has to end with a zero. Every ``sample``-th place of a run keeps its position, and so
    does the first place of each run; other places walk back to one of these.
    """

    def __init__(self, text: np.ndarray, highest: int, sample: int = 16):
        order = suffix_order(text)
        self.ranks = WaveletRanks(text[order - 1], highest)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=highest + 1))))
        first = np.empty(len(text), bool)
        first[0], first[1:] = True, text[:-1] == 0
        kept = (first | (np.arange(len(text)) % sample == 0))[order]
        self.kept, self.number, self.positions = kept, np.cumsum(kept) - 1, order[kept]

    def ranges(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that start with each pattern (equal lengths, one a row), found backwards."""
        last = patterns[:, -1]
        low, high = self.before[last], self.before[last + 1]
        for column in range(patterns.shape[1] - 2, -1, -1):
            symbol = patterns[:, column]
            low, high = self.before[symbol] + self.ranks.rank(symbol, low), self.before[symbol] + self.ranks.rank(symbol, high)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the text of the suffixes in these rows."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        while len(far := np.flatnonzero(~self.kept[rows])):
            symbol, rank = self.ranks.access(rows[far])
            rows[far] = self.before[symbol] + rank
            steps[far] += 1
        return self.positions[self.number[rows]] + steps
