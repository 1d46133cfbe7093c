"""An R-tree over count vectors, and the links between similar sets that it finds.

The members of a set are hashed into groups; a set's point has the number of its members in each group.
Two sets share at most the sum of the smaller coordinates of their points, and a set shares at most as
much with any set below a node as with the node's largest coordinates.
"""

from __future__ import annotations

import numpy as np

GROUPS = 64
FANOUT = 32


def count_vectors(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Members per group of the sets values[first[i]:first[i + 1]]."""
    n = len(first) - 1
    group = (values >> np.uint64(58)).astype(np.int64)
    owner = np.repeat(np.arange(n), np.diff(first))
    return np.bincount(owner * GROUPS + group, minlength=n * GROUPS).reshape(n, GROUPS).astype(np.int32)


def needed(percent: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least common members of sets of a and b members with a Jaccard similarity of `percent` / 100 or more."""
    return -(-percent * (a + b) // (100 + percent))


class CountTree:
    """Packed R-tree: entries in order of size, slabs of these in order of their most varied coordinate."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        n = len(sizes)
        slab = FANOUT * max(1, int(np.sqrt(n / FANOUT)))
        order = np.argsort(sizes, kind="stable")
        varied = vectors[:, int(np.argmax(vectors.var(axis=0)))]
        self.order = order[np.lexsort((varied[order], np.arange(n) // slab))]
        self.levels = []  # from the leaves up: (largest coordinates, smallest size) of each node
        top, least = vectors[self.order], sizes[self.order]
        while True:
            begins = np.arange(0, len(top), FANOUT)
            top, least = np.maximum.reduceat(top, begins), np.minimum.reduceat(least, begins)
            self.levels.append((top, least))
            if len(top) == 1:
                break

    def leaf(self, k: int) -> np.ndarray:
        return self.order[k * FANOUT:(k + 1) * FANOUT]

    def search(self, k: int, percent: int) -> np.ndarray:
        """Leaves from the k-th on that may hold a set similar to one in leaf k."""
        top, least = self.levels[0][0][k], self.levels[0][1][k]
        nodes = np.zeros(1, dtype=np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            tops, leasts = self.levels[depth]
            if depth < len(self.levels) - 1:
                nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                nodes = nodes[nodes < len(tops)]
            nodes = nodes[nodes >= k // FANOUT ** depth]
            bound = np.minimum(tops[nodes], top).sum(axis=1)
            nodes = nodes[bound >= needed(percent, leasts[nodes], least)]
        return nodes


def linked(values: np.ndarray, first: np.ndarray, percent: int, groups: list[np.ndarray] | None = None) -> np.ndarray:
    """For each set (sorted distinct members) the number of the first set it is linked with over any way.

    Two sets link when their Jaccard similarity is `percent` / 100 or more.  With `groups` (numbers of sets)
    only sets that are in a group together are compared.  Pairs that are linked over others already are not
    compared, and subtrees of such pairs not entered, so copies cost about one comparison for each.
    """
    sizes = np.diff(first)
    roots = np.arange(len(sizes))
    vectors = count_vectors(values, first)
    groups = [roots.copy()] if groups is None else groups
    large = [g for g in groups if len(g) > FANOUT]
    for group in sorted(large, key=len, reverse=True):
        _link_by_tree(values, first, sizes, vectors, group, percent, roots)
    _link_pairs(values, first, sizes, vectors, [g for g in groups if 1 < len(g) <= FANOUT], percent, roots)
    return roots


def _link_by_tree(values, first, sizes, vectors, group, percent, roots) -> None:
    """Link the sets of a group through the R-tree of their points; changes `roots`."""
    if (roots[group] == roots[group[0]]).all():
        return
    tree = CountTree(vectors[group], sizes[group])
    leaves = np.arange(len(tree.levels[0][0]))
    begins = leaves * FANOUT
    for k in leaves:
        mine = group[tree.leaf(k)]
        by_leaf = roots[group[tree.order]]
        low, high = np.minimum.reduceat(by_leaf, begins), np.maximum.reduceat(by_leaf, begins)
        others = tree.search(k, percent)
        others = others[(low[others] != high[others]) | (low[others] != low[k]) | (low[k] != high[k])]
        for other in others:
            theirs = group[tree.leaf(other)]
            open_ = roots[mine][:, None] != roots[theirs][None]
            if other == k:
                open_ &= np.tri(len(mine), k=-1, dtype=bool)
            if not open_.any():
                continue
            bound = np.minimum(vectors[mine][:, None], vectors[theirs][None]).sum(axis=2)
            need = needed(percent, sizes[mine][:, None], sizes[theirs][None])
            open_ &= bound >= need
            while open_.any():
                x, y = divmod(int(np.argmax(np.where(open_, bound - need, -1))), len(theirs))
                if _link(values, first, mine[x], theirs[y], need[x, y], roots):
                    open_ &= roots[mine][:, None] != roots[theirs][None]
                else:
                    open_[x, y] = False


PAIRS = 50_000  # looked at together


def _link_pairs(values, first, sizes, vectors, groups, percent, roots) -> None:
    """Link the sets of small groups, by the bounds of all pairs of some groups at once; changes `roots`."""
    by_size: dict[int, list[np.ndarray]] = {}
    for group in groups:
        by_size.setdefault(len(group), []).append(group)
    for size, same in by_size.items():
        i, j = np.triu_indices(size, 1)
        step = max(1, PAIRS // len(i))
        for k in range(0, len(same), step):
            members = np.stack(same[k:k + step])
            a, b = members[:, i].ravel(), members[:, j].ravel()
            open_ = roots[a] != roots[b]
            pairs = np.unique(np.minimum(a, b)[open_] * len(sizes) + np.maximum(a, b)[open_])
            a, b = np.divmod(pairs, len(sizes))
            need = needed(percent, sizes[a], sizes[b])
            open_ = np.minimum(sizes[a], sizes[b]) >= need
            a, b, need = a[open_], b[open_], need[open_]
            spare = np.minimum(vectors[a], vectors[b]).sum(axis=1) - need
            order = np.argsort(-spare, kind="stable")
            for x in order[:np.count_nonzero(spare >= 0)]:
                if roots[a[x]] != roots[b[x]]:
                    _link(values, first, a[x], b[x], need[x], roots)


def _link(values, first, a, b, need, roots) -> bool:
    """Compare two sets, and join their classes if they link."""
    one, other = values[first[a]:first[a + 1]], values[first[b]:first[b + 1]]
    if len(one) > len(other):
        one, other = other, one
    at = np.searchsorted(other, one)
    at[at == len(other)] = 0
    if (other[at] == one).sum() < need:
        return False
    keep, gone = sorted((roots[a], roots[b]))
    roots[roots == gone] = keep
    return True
