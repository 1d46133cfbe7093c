"""Weighted acyclic automata over phrases of a few word numbers; the weight of a phrase is its count.

States are numbered level by level: level d has the states that d words lead to.  An arc carries a word, the
count of the phrase that ends with it (0 if none does) and the state it leads to; a state without arcs is -1.
Built from sorted phrases: as soon as the phrases of a first word are through, the states they opened are
frozen from the last level up, and a state with the same arcs as one in the register is replaced by that one,
so that the automaton has no two equal states on a level.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa

from tidemark.llm.arrays import U64, mix

NONE = -1  # fills phrases that are shorter than the longest
AT_ONCE = 1 << 18  # phrases held at least before equal ones are added up
RUN = 1 << 17  # phrases frozen at a time, up to the next change of the first word


class CountAutomaton:
    """Per level the arcs' words, counts and targets, and the first arc of each state (one more at the end)."""

    def __init__(self, levels: list[dict[str, np.ndarray]]):
        self.levels = levels

    @classmethod
    def build(cls, phrases: np.ndarray, counts: np.ndarray) -> CountAutomaton:
        """Of distinct phrases in ascending order (rows filled up with -1)."""
        registers = [_Register() for _ in range(phrases.shape[1])]
        root = []
        begin, heads = 0, np.flatnonzero(np.append([True], phrases[1:, 0] != phrases[:-1, 0])[:len(phrases)])
        while begin < len(phrases):
            after = np.searchsorted(heads, begin + RUN)
            end = int(heads[after]) if after < len(heads) else len(phrases)
            root.append(_freeze(phrases[begin:end], counts[begin:end], registers))
            begin = end
        arcs = [np.concatenate(x) for x in zip(*root)] if root else [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        levels = [{"word": arcs[0], "count": arcs[1], "target": arcs[2], "first": np.array([0, len(arcs[0])])}]
        return cls(levels + [r.arcs() for r in registers[1:]])

    def phrases(self, ordered: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """All phrases with a count, in ascending order (or level by level)."""
        depth = len(self.levels)
        path, state = np.full((1, depth), NONE, dtype=np.int32), np.zeros(1, dtype=np.int64)
        rows, counts = [], []
        for d, level in enumerate(self.levels):
            size = level["first"][state + 1] - level["first"][state]
            arc = np.repeat(level["first"][state] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            path = np.repeat(path, size, axis=0)
            path[:, d] = level["word"][arc]
            some = level["count"][arc] > 0
            rows.append(path[some])
            counts.append(level["count"][arc][some])
            on = level["target"][arc] >= 0
            path, state = path[on], level["target"][arc][on]
        rows, counts = np.concatenate(rows), np.concatenate(counts)
        if not ordered:
            return rows, counts
        order = _sorted(rows)
        return rows[order], counts[order]

    @classmethod
    def union(cls, automata: Iterable[CountAutomaton], depth: int, least: int = 1) -> CountAutomaton:
        """One automaton for all phrases, counts added up; those that come to less than `least` are left out.

        They are added up as soon as twice as many are held as there were different ones, `AT_ONCE` at least.
        """
        parts, held, most = [], 0, AT_ONCE
        for automaton in automata:
            parts.append(automaton.phrases(ordered=False))
            held += len(parts[-1][1])
            if held > most:
                parts = [summed(parts, depth)]
                held = len(parts[0][1])
                most = max(AT_ONCE, 2 * held)
        return cls.build(*summed(parts, depth, least))

    def compose(self, phrases: np.ndarray) -> np.ndarray:
        """The counts of phrases, read along the arcs word by word; 0 for phrases that are not in it."""
        state, out = np.zeros(len(phrases), dtype=np.int64), np.zeros(len(phrases), dtype=np.int64)
        open_ = np.arange(len(phrases))
        for d, level in enumerate(self.levels[:phrases.shape[1]]):
            open_ = open_[phrases[open_, d] != NONE]
            owner = np.repeat(np.arange(len(level["first"]) - 1), np.diff(level["first"]))
            keys = _arc_key(owner, level["word"])
            wanted = _arc_key(state[open_], phrases[open_, d])
            at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
            hit = keys[at] == wanted if len(keys) else np.zeros(len(wanted), dtype=bool)
            out[open_] = 0
            open_, at = open_[hit], at[hit]
            out[open_] = level["count"][at]
            state[open_] = level["target"][at]
            leaf = (state[open_] < 0) & (phrases[open_, d + 1] != NONE if d + 1 < phrases.shape[1] else False)
            out[open_[leaf]] = 0
            open_ = open_[state[open_] >= 0]
        return out

    def n_states(self) -> int:
        return sum(len(level["first"]) - 1 for level in self.levels)

    def packed(self) -> bytes:
        """Bytes for a shuffle: arrays level by level, bytes of equal weight together, compressed."""
        out = []
        for level in self.levels:
            for name in ("word", "count", "target"):
                values = level[name]
                wide = np.int64 if len(values) and values.max() > np.iinfo(np.int32).max else np.int32
                out.append(_planes(values.astype(wide)))
            out.append(_planes(np.diff(level["first"]).astype(np.int32)))
        head = np.array([x for planes in out for x in planes.shape], dtype=np.int64)
        raw = b"".join([np.array([len(head)], np.int64).tobytes(), head.tobytes(), *(planes.tobytes() for planes in out)])
        return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)

    @classmethod
    def unpacked(cls, data: bytes) -> CountAutomaton:
        raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        shapes = np.frombuffer(raw, np.int64, n, 8).reshape(-1, 2)
        at, arrays = 8 + 8 * n, []
        for width, length in shapes.tolist():
            planes = np.frombuffer(raw, np.uint8, width * length, at).reshape(width, length)
            arrays.append(np.ascontiguousarray(planes.T).view(np.int64 if width == 8 else np.int32).reshape(-1))
            at += width * length
        return cls([{"word": w, "count": c.astype(np.int64), "target": t.astype(np.int64),
                     "first": np.concatenate([[0], np.cumsum(s, dtype=np.int64)])} for w, c, t, s in zip(*[iter(arrays)] * 4)])


class _Register:
    """The frozen states of a level, found by a hash of their arcs and compared arc by arc."""

    def __init__(self):
        self.hashes, self.states = np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)  # sorted by hash
        self.runs, self.n = [], 0
        self.all = {"word": np.zeros(0, np.int32), "count": np.zeros(0, np.int64), "target": np.zeros(0, np.int64), "first": np.zeros(1, np.int64)}

    def arcs(self) -> dict[str, np.ndarray]:
        return self.all

    def enter(self, word: np.ndarray, count: np.ndarray, target: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The numbers of new states with these arcs (state i has first[i]:first[i + 1]), equal ones once."""
        n = len(first) - 1
        size = np.diff(first)
        rank = np.arange(len(word)) - np.repeat(first[:-1], size)
        with np.errstate(over="ignore"):
            value = mix(mix(mix(word.astype(U64)) + count.astype(U64)) + target.astype(U64) + U64(1)) + U64(2) * rank.astype(U64)
            hashes = mix(np.add.reduceat(mix(value), first[:-1]) + size.astype(U64)) if n else np.zeros(0, U64)
        # Equal hashes in this run: the first stands for the others if its arcs are the same.
        order = np.argsort(hashes, kind="stable")
        head = np.append([True], hashes[order][1:] != hashes[order][:-1])[:n]
        stand = np.empty(n, dtype=np.int64)
        stand[order] = order[np.maximum.accumulate(np.where(head, np.arange(n), 0))]
        mine = {"word": word, "count": count, "target": target, "first": first}
        if not _equal(mine, np.arange(n), mine, stand).all():
            raise ValueError("two states of an automaton share a hash")
        fresh = np.unique(stand)
        number = np.full(n, -1, dtype=np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes[fresh]), len(self.hashes) - 1)
            known = self.hashes[at] == hashes[fresh]
            if not _equal(mine, fresh[known], self.all, self.states[at[known]]).all():
                raise ValueError("two states of an automaton share a hash")
            number[fresh[known]] = self.states[at[known]]
            fresh = fresh[~known]
        number[fresh] = self.n + np.arange(len(fresh))
        self.n += len(fresh)
        take = np.repeat(first[fresh] - (np.cumsum(size[fresh]) - size[fresh]), size[fresh]) + np.arange(size[fresh].sum())
        for name in ("word", "count", "target"):
            self.all[name] = np.concatenate([self.all[name], mine[name][take]])
        self.all["first"] = np.concatenate([self.all["first"], self.all["first"][-1] + np.cumsum(size[fresh])])
        hashes_, states = np.concatenate([self.hashes, hashes[fresh]]), np.concatenate([self.states, number[fresh]])
        order = np.argsort(hashes_, kind="stable")
        self.hashes, self.states = hashes_[order], states[order]
        return number[stand]


def _equal(a: dict, i: np.ndarray, b: dict, j: np.ndarray) -> np.ndarray:
    """Whether states i of a have the same arcs as states j of b."""
    size = a["first"][i + 1] - a["first"][i]
    same = size == b["first"][j + 1] - b["first"][j]
    i, j, size = i[same], j[same], size[same]
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    x, y = np.repeat(a["first"][i], size) + step, np.repeat(b["first"][j], size) + step
    differs = np.zeros(len(x), dtype=bool)
    for name in ("word", "count", "target"):
        differs |= a[name][x] != b[name][y]
    bad = np.bincount(np.repeat(np.arange(len(i)), size)[differs], minlength=len(i)) > 0
    same[np.flatnonzero(same)[bad]] = False
    return same


def _freeze(phrases: np.ndarray, counts: np.ndarray, registers: list[_Register]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arcs of the root for a run of sorted phrases; the states below them go to the registers, last level first."""
    depth = phrases.shape[1]
    nodes, parents = [], []  # per level: the phrase row at which each prefix begins, and its parent's number
    new = np.zeros(len(phrases), dtype=bool)
    new[:1] = True
    above = np.zeros(len(phrases), dtype=np.int64)
    for d in range(depth):
        new = new | np.append([True], phrases[1:, d] != phrases[:-1, d])[:len(phrases)]
        real = phrases[:, d] != NONE
        head = np.flatnonzero(new & real)
        nodes.append(head)
        parents.append(above[head])
        above = np.cumsum(new & real) - 1
    length = (phrases != NONE).sum(axis=1)
    target = np.full(len(nodes[-1]), -1, dtype=np.int64)
    for d in range(depth - 1, -1, -1):
        head = nodes[d]
        # The shortest phrase of a prefix sorts first, so a prefix is a phrase itself if its first row ends here.
        arcs = phrases[head, d], np.where(length[head] == d + 1, counts[head], 0), target
        if d == 0:
            return arcs
        owner = parents[d]
        first = np.flatnonzero(np.append([True], owner[1:] != owner[:-1])[:len(owner)])
        states = registers[d].enter(*arcs, np.append(first, len(owner)).astype(np.int64))
        target = np.full(len(nodes[d - 1]), -1, dtype=np.int64)
        target[owner[first]] = states
    raise AssertionError


def _sorted(rows: np.ndarray) -> np.ndarray:
    return np.lexsort(rows.T[::-1])


def summed(parts: list[tuple[np.ndarray, np.ndarray]], depth: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of several sources in ascending order, each once, with their counts added up, if those reach `least`.

    Equal phrases are brought together by a hash, which is one key to sort by instead of `depth`, and then compared.
    """
    if not parts:
        return np.zeros((0, depth), np.int32), np.zeros(0, np.int64)
    rows, counts = np.concatenate([r for r, _ in parts]), np.concatenate([c for _, c in parts])
    value = np.zeros(len(rows), dtype=U64)
    with np.errstate(over="ignore"):
        for d in range(depth):
            value = mix(value + rows[:, d].astype(U64) + U64(0x9E3779B97F4A7C15))
    order = np.argsort(value)
    value, rows, counts = value[order], rows[order], counts[order]
    differs = (rows[1:] != rows[:-1]).any(axis=1)
    if (differs & (value[1:] == value[:-1])).any():  # unequal phrases of one hash
        order = _sorted(rows)
        rows, counts = rows[order], counts[order]
        differs = (rows[1:] != rows[:-1]).any(axis=1)
    first = np.flatnonzero(np.append([True], differs)[:len(rows)])
    rows, counts = rows[first], np.add.reduceat(counts, first) if len(first) else counts
    rows, counts = rows[counts >= least], counts[counts >= least]
    order = _sorted(rows)
    return rows[order], counts[order]


def _arc_key(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (state.astype(np.int64) << 32) | word.astype(np.int64)


def _planes(values: np.ndarray) -> np.ndarray:
    """One row for each byte of the values, so that the empty high bytes lie together."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)


def to_planes(values: np.ndarray) -> bytes:
    """32-bit numbers as compressed bytes, those of equal weight together."""
    raw = _planes(values.astype(np.int32)).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def from_planes(data: bytes) -> np.ndarray:
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view(np.int32).reshape(-1)
