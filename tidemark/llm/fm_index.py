"""An FM-index over numbered symbols: wavelet-tree ranks, backward search, sampled suffix positions."""

from __future__ import annotations

import numpy as np

from tidemark.llm.suffixes import suffix_array

SAMPLE = 16  # every so many text positions are kept


class FMIndex:
    """Index of a text of symbols 1..2^bits - 1; the symbol 0 is its end mark and may not occur in it."""

    def __init__(self, text: np.ndarray, bits: int):
        text = np.append(text, 0).astype(np.int64)
        n = len(text)
        order = suffix_array(text, bits)
        last = text[order - 1]  # the symbol before each suffix
        self.n, self.bits = n, bits
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])[:1 << bits]
        # Wavelet tree as a matrix: at each level the zeros of a bit move to the front, in their order.
        self.zeros, self.before = [], []
        level = last
        for bit in range(bits - 1, -1, -1):
            one = (level >> bit) & 1
            before = np.zeros(n + 1, dtype=np.int32)
            np.cumsum(one, out=before[1:])
            self.before.append(before)  # ones before a place
            self.zeros.append(n - int(before[-1]))
            level = np.concatenate([level[one == 0], level[one == 1]])
        self.last = last.astype(np.int32)
        self.sampled = order % SAMPLE == 0
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)[:-1]])
        self.samples = order[self.sampled]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before the place in the last column."""
        low, high = np.zeros_like(place), place
        for depth, (before, zeros) in enumerate(zip(self.before, self.zeros)):
            one = ((symbol >> (self.bits - 1 - depth)) & 1).astype(bool)
            a, b = before[low], before[high]
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return high - low

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes [low, high) that begin with each pattern (rows, filled up with 0 at the end)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for j in range(patterns.shape[1] - 1, -1, -1):
            at = np.flatnonzero((j < lengths) & (low < high))
            symbol = patterns[at, j].astype(np.int64)
            low[at] = self.first[symbol] + self.rank(symbol, low[at])
            high[at] = self.first[symbol] + self.rank(symbol, high[at])
        return low, np.maximum(low, high)

    def locate(self, place: np.ndarray) -> np.ndarray:
        """Text position of each entry of the suffix order, by walking back to a sampled one."""
        place = place.copy()
        steps = np.zeros(len(place), dtype=np.int64)
        walking = np.flatnonzero(~self.sampled[place])
        while len(walking):
            symbol = self.last[place[walking]].astype(np.int64)
            place[walking] = self.first[symbol] + self.rank(symbol, place[walking])
            steps[walking] += 1
            walking = walking[~self.sampled[place[walking]]]
        return self.samples[self.sample_rank[place]] + steps
