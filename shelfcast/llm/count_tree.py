"""R-tree over group counts of shingle sets, and the links it finds.

Shingles are hashed to groups; a set becomes the point of its group counts. Two sets share at most the sum, over
the groups, of the smaller count; two boxes of points at most the sum of the smaller upper corner. Box pairs and
point pairs whose bound is below the overlap that the similarity needs are skipped, the others are verified on the
sets. Pairs already connected are skipped too, so the links returned are a spanning forest.
"""

from __future__ import annotations

import numpy as np

LEAF = 16
#: Most entries of the matrix of counts.
ENTRIES = 8_000_000


class CountTree:
    """Packed by halving at the median of the coordinate with the greatest spread."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.counts, self.sizes = counts, sizes
        self.high: list[np.ndarray] = []
        self.low_size: list[int] = []
        self.high_size: list[int] = []
        self.children: list[tuple[int, int] | None] = []
        self.members: list[np.ndarray] = []
        self.root = self._build(np.arange(len(sizes)))

    def _build(self, rows: np.ndarray) -> int:
        at = len(self.high)
        counts, sizes = self.counts[rows], self.sizes[rows]
        self.high.append(counts.max(axis=0))
        self.low_size.append(int(sizes.min()))
        self.high_size.append(int(sizes.max()))
        self.children.append(None)
        self.members.append(rows)
        if len(rows) > LEAF:
            spread = self.high[at] - counts.min(axis=0)
            key = sizes if np.ptp(sizes) >= spread.max() else counts[:, spread.argmax()]
            order = np.argsort(key, kind="stable")
            half = len(rows) // 2
            self.children[at] = (self._build(rows[order[:half]]), self._build(rows[order[half:]]))
        return at

    def may_link(self, x: int, y: int, percent: int) -> bool:
        small = min(self.high_size[x], self.high_size[y])
        if 100 * small < percent * max(self.low_size[x], self.low_size[y]):
            return False
        shared = int(np.minimum(self.high[x], self.high[y]).sum())
        return (100 + percent) * shared >= percent * (self.low_size[x] + self.low_size[y])

    def leaf_pairs(self, percent: int):
        """Pairs of leaves that may hold a link, a leaf with itself included."""
        stack = [(self.root, self.root)]
        while stack:
            x, y = stack.pop()
            if x != y and not self.may_link(x, y, percent):
                continue
            if self.children[x] is None and self.children[y] is None:
                yield self.members[x], self.members[y]
            elif x == y:
                a, b = self.children[x]
                stack += [(a, b), (b, b), (a, a)]
            elif self.children[y] is None or (
                self.children[x] is not None and len(self.members[x]) >= len(self.members[y])
            ):
                stack += [(c, y) for c in self.children[x]]
            else:
                stack += [(x, c) for c in self.children[y]]


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)
        return i != j


def links(sets: list[np.ndarray], percent: int, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Spanning forest of the links between sorted sets whose Jaccard similarity is `percent` or more.

    With `sides`, only pairs from different sides are compared.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    groups = int(min(max(32, np.median(sizes) // 8), max(32, ENTRIES // len(sets))))
    counts = np.empty((len(sets), groups), np.int32)
    for i, s in enumerate(sets):
        counts[i] = np.bincount((s % np.uint64(groups)).astype(np.int64), minlength=groups)
    forest, found = Forest(len(sets)), []
    tree = CountTree(counts, sizes)
    for xs, ys in tree.leaf_pairs(percent):
        shared = np.minimum(counts[xs][:, None], counts[ys][None]).sum(axis=2)
        fits = (100 + percent) * shared >= percent * (sizes[xs][:, None] + sizes[ys][None])
        for p, q in zip(*np.nonzero(fits), strict=True):
            i, j = int(xs[p]), int(ys[q])
            if i == j or (sides is not None and sides[i] == sides[j]) or forest.find(i) == forest.find(j):
                continue
            overlap = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * overlap >= percent * (len(sets[i]) + len(sets[j]) - overlap):
                forest.join(i, j)
                found.append((i, j))
    return found
