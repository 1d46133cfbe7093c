"""Suffix arrays in numpy: Larsson-Sadakane refinement, and Kasai's common prefixes walked in lanes."""

from __future__ import annotations

import numpy as np

LANES = 2048


def suffix_array(text: np.ndarray, bits: int = 8) -> np.ndarray:
    """Starts of all suffixes of symbols of so many bits, in order (the end of the text sorts first).

    Groups of suffixes that agree on their first h symbols are refined by the group of the suffix h symbols
    on; groups of one are left alone, and h doubles until there are no others.
    """
    n, h = len(text), 64 // bits
    if n >= 1 << 31:
        raise ValueError("a shard holds less than 2^31 symbols")
    padded = np.concatenate([text, np.zeros(h, text.dtype)])
    key = np.zeros(n, dtype=np.uint64)  # the first h symbols in one number
    for i in range(h):
        key = (key << np.uint64(bits)) | padded[i:n + i].astype(np.uint64)
    # Among suffixes that end within these symbols and agree with the padding, the shorter comes first.
    rest = np.minimum(np.arange(n, 0, -1), h)
    order = np.lexsort((rest, key))
    differs = np.append([True], (key[order[1:]] != key[order[:-1]]) | (rest[order[1:]] != rest[order[:-1]]))[:n]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(differs, np.arange(n), 0))
    at = np.arange(n)
    while True:
        group = rank[order[at]]
        alone = np.append([True], group[1:] != group[:-1]) & np.append(group[1:] != group[:-1], True) if len(at) else group > 0
        at = at[~alone]
        if not len(at):
            return order
        place = order[at]
        group = rank[place]
        beyond = place + h
        key = (group << 32) | np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        place, key = place[by], key[by]
        order[at] = place
        differs = np.append([True], key[1:] != key[:-1])
        rank[place] = at[np.maximum.accumulate(np.where(differs, np.arange(len(at)), 0))]
        h *= 2


def common_prefixes(text: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """For each entry of the suffix array, the bytes it shares with the entry before it, up to `cap`.

    Kasai's walk in text order: the suffix one byte on shares at least one byte less.  Each lane walks a
    stretch of the text of its own; in every step a lane either matches one more byte or moves on.
    """
    n = len(text)
    out = np.zeros(n, dtype=np.int32)
    if n < 2:
        return out
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    edges = np.linspace(0, n, min(LANES, n) + 1).astype(np.int64)
    i, stop = edges[:-1].copy(), edges[1:]
    h = np.zeros(len(i), dtype=np.int64)
    while len(i):
        j = before[i]
        a, b = i + h, j + h
        more = (j >= 0) & (a < n) & (b < n) & (h < cap)
        more &= text[np.minimum(a, n - 1)] == text[np.minimum(b, n - 1)]
        h[more] += 1
        done = ~more
        out[rank[i[done]]] = h[done]
        h[done] = np.maximum(h[done] - 1, 0)
        i = i + done
        if (i == stop).any():
            left = i < stop
            i, stop, h = i[left], stop[left], h[left]
    return out


def merge(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs (each without repeats) merged by binary search: all values, and which are in several runs."""
    level = [(run, np.zeros(len(run), dtype=bool)) for run in runs] or [(np.zeros(0, np.uint64), np.zeros(0, bool))]
    while len(level) > 1:
        above = []
        for k in range(0, len(level) - 1, 2):
            (a, several), (b, other) = sorted(level[k:k + 2], key=lambda x: -len(x[0]))
            at = np.searchsorted(a, b)
            equal = np.append(a, a[-1:])[at] == b if len(a) else np.zeros(len(b), dtype=bool)
            several = several.copy()
            several[at[equal]] = True
            above.append((np.insert(a, at[~equal], b[~equal]), np.insert(several, at[~equal], other[~equal])))
        level = above + level[len(level) // 2 * 2:]
    return level[0]
