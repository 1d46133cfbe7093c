"""A minimal perfect hash over 96-bit keys, built and probed with numpy.

Keys are dealt into slots of a level about twice as large as their number; those alone in their slot are
placed, the others go on to the next level.  A key's index is the number of placed keys before its slot, so
that n keys have the indexes 0 .. n - 1 and the structure itself needs some four bits a key, without the keys.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.arrays import U64, mix

LEVEL = U64(0x9E3779B97F4A7C15)
MOST_LEVELS = 64


def _slot(hashes: np.ndarray, marks: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        spread = mix(hashes ^ mix(marks.astype(U64) + LEVEL * U64(level + 1)))
    return (((spread >> U64(32)) * U64(size)) >> U64(32)).astype(np.int64)


class PerfectHash:
    """`sizes` of the levels, and their slots' bits one level after another."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.taken = np.unpackbits(bits, count=int(sizes.sum())).astype(bool)
        self.before = np.cumsum(self.taken) - self.taken

    @classmethod
    def build(cls, hashes: np.ndarray, marks: np.ndarray) -> PerfectHash:
        """Of distinct (hash, mark) pairs; equal pairs are an error."""
        sizes, taken = [], []
        while len(hashes):
            if len(sizes) == MOST_LEVELS:
                raise ValueError("equal keys in a perfect hash")
            size = 2 * len(hashes) + 1
            slot = _slot(hashes, marks, len(sizes), size)
            alone = np.bincount(slot, minlength=size) == 1
            sizes.append(size)
            taken.append(alone)
            left = ~alone[slot]
            hashes, marks = hashes[left], marks[left]
        bits = np.packbits(np.concatenate(taken)) if taken else np.zeros(0, np.uint8)
        return cls(np.array(sizes, dtype=np.int64), bits)

    def index(self, hashes: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """The index of each key; of a pair that was not built in, any index or -1."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        open_, begin = np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes.tolist()):
            slot = begin + _slot(hashes[open_], marks[open_], level, size)
            hit = self.taken[slot]
            out[open_[hit]] = self.before[slot[hit]]
            open_, begin = open_[~hit], begin + size
        return out
