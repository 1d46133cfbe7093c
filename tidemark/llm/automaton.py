"""Rule regexes as one deterministic automaton over bytes, and its run over many texts at once.

Patterns are parsed by Python's own regex parser; supported are literals, classes, groups, alternatives
and repeats.  Thompson's construction gives the nondeterministic automaton, subset construction the
deterministic one (bytes that no rule tells apart share a column), and partition refinement the smallest.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as op
from re import _parser

import numpy as np

LANES = 4096


def _bytes_of(items, flags: int) -> int:
    """A set of bytes as the bits of a number."""
    mask, negate = 0, False
    for kind, value in items:
        if kind is op.NEGATE:
            negate = True
        elif kind is op.LITERAL:
            mask |= 1 << value
        elif kind is op.RANGE:
            mask |= sum(1 << b for b in range(value[0], value[1] + 1))
        else:
            raise ValueError(f"not supported in a class: {kind}")
    if flags & re.IGNORECASE:
        for upper in range(0x41, 0x5B):
            if mask >> upper & 1 or mask >> (upper + 32) & 1:
                mask |= 1 << upper | 1 << (upper + 32)
    return ~mask & (1 << 256) - 1 if negate else mask


class _Nondeterministic:
    def __init__(self):
        self.steps: list[list[tuple[int, int]]] = []  # by state: (set of bytes, next state)
        self.free: list[list[int]] = []  # by state: next states without a byte

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, items, start: int, flags: int) -> int:
        """Append a parsed pattern after `start`; returns the state it ends in."""
        for kind, value in items:
            if kind in (op.LITERAL, op.NOT_LITERAL, op.IN):
                members = value if kind is op.IN else [(op.LITERAL, value)]
                end = self.state()
                mask = _bytes_of(members, flags)
                self.steps[start].append((~mask & (1 << 256) - 1 if kind is op.NOT_LITERAL else mask, end))
                start = end
            elif kind is op.SUBPATTERN:
                _, more, less, inner = value
                start = self.add(inner, start, (flags | more) & ~less)
            elif kind is op.BRANCH:
                end = self.state()
                for branch in value[1]:
                    begin = self.state()
                    self.free[start].append(begin)
                    self.free[self.add(branch, begin, flags)].append(end)
                start = end
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
                least, most, inner = value
                for _ in range(least):
                    start = self.add(inner, start, flags)
                if most is op.MAXREPEAT:
                    begin = self.state()
                    self.free[start].append(begin)
                    self.free[self.add(inner, begin, flags)].append(begin)
                    start = begin
                else:
                    end = self.state()
                    for _ in range(most - least):
                        self.free[start].append(end)
                        start = self.add(inner, start, flags)
                    self.free[start].append(end)
                    start = end
            else:
                raise ValueError(f"not supported in a rule: {kind}")
        return start

    def reach(self, states) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """`step[state * columns + column_of[byte]]` is the next state; state 0 is the start, column 0 a break between texts."""

    column_of: np.ndarray
    columns: int
    step: np.ndarray
    accepts: np.ndarray  # by state: a bit for each rule that ends here
    known: np.ndarray  # by pair of columns: the state after it, whatever was before, or -1
    breaks: np.ndarray  # by byte: no match contains it

    def ends(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, rules) of each byte at which a match of some rule ends, in one pass over all bytes.

        The texts are cut into lanes at pairs of bytes after which the state is known; all lanes step together.
        """
        sizes = np.diff(offsets)
        codes = np.zeros(len(buf) + len(sizes), dtype=np.uint8)  # a break after each text
        at = np.arange(len(buf)) + np.repeat(np.arange(len(sizes)), sizes)
        codes[at] = self.column_of[buf]
        n = len(codes)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, self.accepts.dtype)
        after = self.known[codes[:-1].astype(np.int64) * self.columns + codes[1:]]
        cut = np.flatnonzero(after >= 0)
        lanes = min(LANES, max(1, n // 64))
        chosen = np.unique(np.searchsorted(cut, np.arange(1, lanes) * (n / lanes)))
        chosen = cut[chosen[chosen < len(cut)]]
        place = np.concatenate([[0], chosen + 2])
        state = np.concatenate([[0], after[chosen]]).astype(np.int64)
        good = place < n
        place, state = place[good], state[good]
        stop = np.append(place[1:], n)
        order = np.argsort(place - stop, kind="stable")  # long lanes first, so that those at work stay in front
        place, state, stop = place[order], state[order], stop[order]
        size = stop - place
        busy = len(place) - np.searchsorted(size[::-1], np.arange(size[0]), "right") if len(size) else []
        found, rules = [], []
        for k, lanes in enumerate(busy):
            state = state[:lanes]
            np.multiply(state, self.columns, out=state)
            state += codes[place[:lanes] + k]
            state = self.step[state]
            some = self.accepts[state]
            if some.any():
                hit = np.flatnonzero(some)
                found.append(place[hit] + k)
                rules.append(some[hit])
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, self.accepts.dtype)
        found, rules = np.concatenate(found), np.concatenate(rules)
        order = np.argsort(found)
        found = found[order]
        # From places among the codes back to places in the buffer.
        text = np.searchsorted(offsets[1:] + np.arange(len(sizes)), found)
        return found - text, rules[order]


def compile_rules(patterns: list[str]) -> Automaton:
    """One automaton for the patterns, each of which may begin anywhere."""
    nfa = _Nondeterministic()
    begin = nfa.state()
    accept: dict[int, int] = {}
    for k, pattern in enumerate(patterns):
        first = nfa.state()
        nfa.free[begin].append(first)
        accept[nfa.add(_parser.parse(pattern.encode()), first, 0)] = 1 << k
    # Bytes that are in the same sets share a column; column 0 is a break.
    sets = sorted({mask for steps in nfa.steps for mask, _ in steps})
    kinds: dict[tuple, int] = {}
    column_of = np.array([kinds.setdefault(tuple(mask >> b & 1 for mask in sets), len(kinds)) + 1 for b in range(256)], np.uint8)
    columns = len(kinds) + 1
    sample = [int(np.flatnonzero(column_of == c)[0]) for c in range(1, columns)]
    home = nfa.reach([begin])
    numbers, todo, table = {home: 0}, [home], []
    moves: dict[tuple[int, int], frozenset[int]] = {}
    for states in todo:
        row = [0]
        for byte in sample:
            to = set(home)
            for s in states:
                if (s, byte) not in moves:
                    moves[s, byte] = nfa.reach([t for mask, t in nfa.steps[s] if mask >> byte & 1])
                to |= moves[s, byte]
            key = frozenset(to)
            if key not in numbers:
                numbers[key] = len(numbers)
                todo.append(key)
            row.append(numbers[key])
        table.append(row)
    step = np.array(table)
    accepts = np.array([sum(accept[s] for s in states & accept.keys()) for states in todo], dtype=np.int64)
    step, accepts = _smallest(step, accepts)
    two = step[step]  # [state, first column, second column]
    known = np.where((two == two[:1]).all(axis=0), two[0], -1).ravel()
    breaks = (step == 0).all(axis=0)[column_of]
    return Automaton(column_of, columns, step.ravel(), accepts, known, breaks)


def _smallest(step: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merges states that no continuation tells apart, by refining the partition by what they accept."""
    _, block = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    _, first = np.unique(block, return_index=True)
    number = np.empty(len(first), dtype=np.int64)  # the start stays 0
    number[block[np.sort(first)]] = np.arange(len(first))
    keep = np.sort(first)
    return number[block[step[keep]]], accepts[keep]
