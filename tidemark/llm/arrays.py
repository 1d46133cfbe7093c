"""Numpy helpers on whole Arrow columns of text: words, hashes of word runs, sliding minima.

All of them work on the UTF-8 bytes of many texts at once, so that no Python code runs per word.
Hashes are 64 bits wide, deterministic, and the same in every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the rolling hashes (golden ratio and two splitmix constants).
BYTE_BASE, WORD_BASE, MIX_A, MIX_B = (U64(x) for x in (
    0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
BLOCK = 1 << 20  # bytes hashed at once; bounds the temporary arrays, not the texts


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bit numbers that spreads every bit over all others."""
    x = x ^ (x >> U64(30))
    x = x * MIX_A
    x ^= x >> U64(27)
    x *= MIX_B
    x ^= x >> U64(31)
    return x


def byte_class(separators: bytes) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[np.frombuffer(separators, dtype=np.uint8)] = False
    return table


#: Characters of `[^\x20\x09-\x0D]+` and, after lower-casing A-Z, of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
NOT_SPACE = byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
ALNUM = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))[LOWER]
_BYTES = mix(np.arange(1, 257, dtype=U64) * BYTE_BASE)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[bool, np.ndarray] = {}
_INVERSE = U64(pow(int(BYTE_BASE), -1, 1 << 64))


def _byte_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > BLOCK:
        return powers(BYTE_BASE, n), powers(_INVERSE, n)
    if not _POWERS:
        _POWERS[True], _POWERS[False] = powers(BYTE_BASE, BLOCK), powers(_INVERSE, BLOCK)
    return _POWERS[True][:n], _POWERS[False][:n]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column of strings; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


class Words:
    """Words of several texts: byte ranges [start, end), and for text i the words first[i]:first[i + 1]."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.buf, self.offsets = buf, offsets
        inside = np.zeros(len(buf) + 2, dtype=bool)
        inside[1:-1] = table[buf]
        begins = inside[1:-1] & ~inside[:-2]
        ends = inside[1:-1] & ~inside[2:]
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < len(buf))]
        begins[edge] = inside[1:-1][edge]
        ends[edge - 1] = inside[1:-1][edge - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.table = table

    def __len__(self) -> int:
        return len(self.start)

    def left_in_text(self) -> np.ndarray:
        """For each word, the number of words from it to the end of its text."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self))

    def hashes(self, translate: np.ndarray | None = None) -> np.ndarray:
        """One 64 bit hash for each word, of its bytes after `translate`."""
        values = np.where(self.table, _BYTES if translate is None else _BYTES[translate], U64(0))
        out = np.empty(len(self), dtype=U64)
        i = 0
        while i < len(self):
            low = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, low + BLOCK, "right")))
            up, down = _byte_powers(int(self.end[j - 1] - low))
            v = values[self.buf[low:self.end[j - 1]]]
            v *= up
            at = self.start[i:j] - low
            out[i:j] = np.add.reduceat(v, at) * down[at]
            i = j
        return mix(out)


def runs(x: np.ndarray, n: int, base: np.uint64 = WORD_BASE) -> np.ndarray:
    """Hash of x[i:i + n] for each i; has len(x) - n + 1 entries (none if x is shorter)."""
    if len(x) < n:
        return np.zeros(0, dtype=U64)
    out, have, part, size = None, 0, x, 1
    while True:
        if n & size:
            out = part if out is None else out[:len(x) - have - size + 1] + _power(base, have) * part[have:len(x) - size + 1]
            have += size
        if have == n:
            return mix(out[:len(x) - n + 1])
        part = part[:len(part) - size] + _power(base, size) * part[size:]
        size *= 2


def _power(base: np.uint64, n: int) -> np.uint64:
    return U64(pow(int(base), n, 1 << 64))


POSITION = U64((1 << 28) - 1)  # low bits of a packed key; the rest is hash


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """For each run of `window` entries the place of its smallest hash (of equal ones, the first).

    Equal runs choose the same place within them, wherever they stand.
    """
    if len(grams) < window:
        return np.zeros(0, dtype=np.int64)
    if len(grams) > int(POSITION):
        raise ValueError("more than 2^28 entries in one chunk")
    low = (grams & ~POSITION) | np.arange(len(grams), dtype=U64)
    have = 1
    while 2 * have <= window:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < window:
        low = np.minimum(low[:len(low) - (window - have)], low[window - have:])
    return (low & POSITION).astype(np.int64)


def contains(ordered: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of x are in the sorted array."""
    if not len(ordered):
        return np.zeros(len(x), dtype=bool)
    at = np.searchsorted(ordered, x)
    at[at == len(ordered)] = 0
    return ordered[at] == x


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash; sorted hashes have sorted parts."""
    return (((hashes >> U64(32)) * U64(parts)) >> U64(32)).astype(np.int64)


def list_array(sizes: np.ndarray, values: pa.Array) -> pa.Array:
    """Rows of lists with so many of the values each."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def gather_bytes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, space_before: np.ndarray, space: int = 0x20) -> np.ndarray:
    """The byte ranges one after another, each after a space (or another byte) where asked for."""
    size = (end - start) + space_before
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    out = np.empty(total, dtype=np.uint8)
    i = 0
    while i < len(start):  # in blocks, for the index array is eight times as large as the text
        low = stop[i] - size[i]
        j = max(i + 1, int(np.searchsorted(stop, low + BLOCK, "right")))
        at = np.repeat(start[i:j] - space_before[i:j] - (stop[i:j] - size[i:j] - low), size[i:j]) + np.arange(stop[j - 1] - low)
        out[low:stop[j - 1]] = buf[np.maximum(at, 0)]
        i = j
    out[(stop - size)[space_before.astype(bool)]] = space
    return out


def texts_of(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Cuts UTF-8 bytes into texts of the given sizes."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())


def flag_runs(flags: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, text) of the maximal runs of set flags; text i has the entries first[i]:first[i + 1]."""
    edge = np.append([True], flags[1:] != flags[:-1])[:len(flags)]
    edge[first[:-1][first[:-1] < len(flags)]] = True
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], len(flags))[:len(begin)]
    begin, end = begin[flags[begin]], end[flags[begin]]
    return begin, end, np.searchsorted(first, begin, "right") - 1


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in one of the ranges [start, start + length)."""
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + length, n), -1)
    return np.cumsum(change[:-1]) > 0


def byte_values(buf: np.ndarray) -> np.ndarray:
    return _BYTES[buf]


class RangeHashes:
    """Hashes of any byte ranges of one buffer."""

    def __init__(self, buf: np.ndarray):
        self.sums = np.zeros(len(buf) + 1, dtype=U64)
        np.cumsum(_BYTES[buf] * powers(BYTE_BASE, len(buf)), out=self.sums[1:])
        self.down = powers(_INVERSE, len(buf) + 1)

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin])


def ranges(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """[start, start + length) for ascending starts, those that overlap or touch merged."""
    if not len(starts):
        return starts, starts
    head = np.append([True], np.diff(starts) > length)
    return starts[head], np.append(starts[:-1][head[1:]], starts[-1]) + length
