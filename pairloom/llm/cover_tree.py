"""Cover trees over unit vectors, and the traversal of two of them at once for pairs within a distance.

A tree's node holds the points within a radius of its centre. Its children's centres are a net of those points: each
point is within the next level's radius of one, and no two of them are; radii halve from level to level (levels at which
a node would have one child are passed over). Nodes also keep the true distance of their farthest point, by which the
traversal decides pairs of nodes: if even the nearest points are too far apart the pair is pruned, if even the farthest
are within the limit all pairs of points count at once, and only what is left goes down to the children and, at leaves,
to the points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Points of a leaf at most, if they aren't equal; centres that are picked from at once; points of a compared block.
LEAF, PICK, CHUNK = 32, 64, 1024
#: Distances come from products and are off by less; within this of a limit nothing is decided by bounds.
MARGIN = 1e-6
#: Links that are held before they are merged into groups.
HELD = 1 << 20


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between rows of unit vectors."""
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


class Groups:
    """Connected groups of 0..n-1; a group's root is its least member."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = np.flatnonzero(x != y)
            if not len(apart):
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (up := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = up


class CoverTree:
    """Nodes: ``center`` (a point), ``radius`` (of its points), points ``order[low:high]``, children ``first`` to ``last``."""

    def __init__(self, points: np.ndarray) -> None:
        n = len(points)
        self.points, self.order = points, np.arange(n)
        centers, radii, lows, highs = ([0], [float(distances(points[:1], points).max())], [0], [n]) if n else ([], [], [], [])
        todo, spans = [(0, 2.0)] if n > LEAF else [], {}
        while todo:
            node, reach = todo.pop()
            if radii[node] <= MARGIN:
                continue  # equal points: no net tells them apart
            while reach >= radii[node]:
                reach /= 2
            low, start = lows[node], len(centers)
            net, sizes, far = self._split(low, highs[node], reach)
            ends = low + np.cumsum(sizes)
            centers += net
            radii += far.tolist()
            lows += (ends - sizes).tolist()
            highs += ends.tolist()
            spans[node] = (start, len(centers))
            todo += [(start + int(k), reach) for k in np.flatnonzero(sizes > LEAF)]
        self.center, self.low, self.high = (np.array(c, int) for c in (centers, lows, highs))
        self.radius = np.array(radii, float)
        self.first, self.last = np.zeros(len(centers), int), np.zeros(len(centers), int)
        for node, (a, b) in spans.items():
            self.first[node], self.last[node] = a, b

    def _split(self, low: int, high: int, reach: float) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Centres, sizes and radii of the children of order[low:high], which is put in their order."""
        mine, x = self.order[low:high].copy(), self.points
        of, far = np.empty(len(mine), int), np.empty(len(mine))
        centers: list[int] = []
        left = np.arange(len(mine))
        while len(left):
            some = mine[left[:PICK]]
            between, picked = distances(x[some], x[some]), []
            for k in range(len(some)):
                if all(between[k, p] > reach for p in picked):
                    picked.append(k)
            d = distances(x[mine[left]], x[some[picked]])
            d[picked, np.arange(len(picked))] = 0
            near, at = d.min(1), d.argmin(1)
            got = near <= reach
            of[left[got]], far[left[got]] = at[got] + len(centers), near[got]
            centers += some[picked].tolist()
            left = left[~got]
        ranked = np.argsort(of, kind="stable")
        self.order[low:high] = mine[ranked]
        radii = np.zeros(len(centers))
        np.maximum.at(radii, of, far)
        return centers, np.bincount(of, minlength=len(centers)), radii

    def is_leaf(self, nodes: np.ndarray) -> np.ndarray:
        return self.first[nodes] == self.last[nodes]

    def below(self, node: int) -> np.ndarray:
        return np.arange(self.first[node], self.last[node]) if self.last[node] > self.first[node] else np.array([node])

    def members(self, node: int) -> np.ndarray:
        return self.order[self.low[node] : self.high[node]]


def _blocks(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    for i in range(0, len(a), CHUNK):
        for j in range(0, len(b), CHUNK):
            yield a[i : i + CHUNK], b[j : j + CHUNK], i == j


class Links:
    """Links between the points of ``a``, whose weights count, and those of ``b``, or of ``a`` itself.

    ``of_b`` (``of_a`` without ``b``): summed weights of the points of ``a`` that each point is linked with, without
    itself. ``groups`` connects what is linked; points of ``b`` follow those of ``a``.
    """

    def __init__(self, a: CoverTree, weights: np.ndarray, b: CoverTree | None, least: float, groups: Groups | None = None) -> None:
        self.a, self.b, self.same, self.least = a, b or a, b is None, least
        self.reach = float(np.sqrt(max(0.0, 2 - 2 * least)))
        self.weights, self.n = weights, len(a.points)
        self.sums = np.concatenate([[0], np.cumsum(weights[a.order])])
        self.found = np.zeros(len(self.b.points), np.int64)
        self.whole_a, self.whole_b = np.zeros(len(a.center), bool), np.zeros(len(self.b.center), bool)
        self.more = np.zeros(len(self.b.center), np.int64)
        self.groups = groups or Groups(self.n + (0 if self.same else len(self.b.points)))
        self.at = 0 if self.same else self.n
        self._held: list[tuple[np.ndarray, np.ndarray]] = []
        self._count = 0
        if self.n and len(self.b.points):
            self._run()
            self._finish()

    def _weight(self, nodes: np.ndarray) -> np.ndarray:
        return self.sums[self.a.high[nodes]] - self.sums[self.a.low[nodes]]

    def _hold(self, x: np.ndarray, y: np.ndarray) -> None:
        self._held.append((x, y))
        self._count += len(x)
        if self._count > HELD:
            self._flush()

    def _flush(self) -> None:
        if self._held:
            self.groups.merge(*(np.concatenate(c) for c in zip(*self._held, strict=True)))
        self._held, self._count = [], 0

    def _run(self) -> None:
        todo = [(np.zeros(1, int), np.zeros(1, int))]
        leaves: list[tuple[np.ndarray, np.ndarray]] = []
        while todo:
            left, right = todo.pop()
            mirrored = self.same and left is right
            for x, y, diagonal in _blocks(left, right):
                if mirrored and x[0] > y[0]:
                    continue
                own = mirrored and diagonal
                d = distances(self.a.points[self.a.center[x]], self.b.points[self.b.center[y]])
                spread = self.a.radius[x][:, None] + self.b.radius[y]
                if own:
                    d[np.arange(len(x)), np.arange(len(x))] = spread[np.arange(len(x)), np.arange(len(x))] = 0
                i, j = np.nonzero(d - spread <= self.reach + MARGIN)  # the others are pruned
                if own:
                    i, j = i[i <= j], j[i <= j]
                near = d[i, j] + spread[i, j] < self.reach - MARGIN
                if own:  # a node with itself: all of its points are within twice its radius; one point has no other
                    near = np.where(i == j, 2 * self.a.radius[x[i]] < self.reach - MARGIN, near)
                    some = (i != j) | (self.a.high[x[i]] - self.a.low[x[i]] > 1)
                    i, j, near = i[some], j[some], near[some]
                self._all(x[i[near]], y[j[near]])
                i, j = x[i[~near]], y[j[~near]]
                ends = self.a.is_leaf(i) & self.b.is_leaf(j)
                leaves.append((i[ends], j[ends]))
                if sum(len(k[0]) for k in leaves) > HELD:
                    self._points(leaves)
                    leaves = []
                for p, q in zip(i[~ends].tolist(), j[~ends].tolist(), strict=True):
                    under = self.a.below(p)
                    todo.append((under, under if self.same and p == q else self.b.below(q)))
        self._points(leaves)

    def _all(self, x: np.ndarray, y: np.ndarray) -> None:
        """Every point of the nodes x with every one of the nodes y beside it."""
        np.add.at(self.more, y, self._weight(x))
        if self.same:
            apart = x != y
            np.add.at(self.more, x[apart], self._weight(y[apart]))
            for node in x[~apart]:
                points = self.a.members(node)
                self.found[points] -= self.weights[points]
        self.whole_a[x] = True
        self.whole_b[y] = True
        self._hold(self.a.center[x], self.at + self.b.center[y])

    def _points(self, leaves: list[tuple[np.ndarray, np.ndarray]]) -> None:
        x, y = (np.concatenate(c) for c in zip(*leaves, strict=True)) if leaves else (np.zeros(0, int),) * 2
        pairs = (self.a.high[x] - self.a.low[x]) * (self.b.high[y] - self.b.low[y])
        ends = np.cumsum(pairs)
        most = 1 << 16
        start = 0
        while start < len(x):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
            if stop == start + 1 and pairs[start] > most:
                for p, q, _ in _blocks(self.a.members(x[start]), self.b.members(y[start])):
                    self._compare(np.repeat(p, len(q)), np.tile(q, len(p)), x[start] == y[start], p, q)
            else:
                u, v = x[start:stop], y[start:stop]
                n = pairs[start:stop]
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                wide = np.repeat(self.b.high[v] - self.b.low[v], n)
                p = self.a.order[np.repeat(self.a.low[u], n) + at // wide]
                q = self.b.order[np.repeat(self.b.low[v], n) + at % wide]
                self._compare(p, q, np.repeat(u == v, n))
            start = stop

    def _compare(self, p: np.ndarray, q: np.ndarray, inside: np.ndarray | bool, rows: np.ndarray | None = None, columns: np.ndarray | None = None) -> None:
        """Single points; ``inside``: of one leaf, which gives each pair twice."""
        if rows is not None and columns is not None:
            cosine = (self.a.points[rows] @ self.b.points[columns].T).ravel()
        else:
            cosine = np.einsum("ij,ij->i", self.a.points[p], self.b.points[q])
        linked = cosine >= self.least
        if self.same:
            linked &= p != q
        twice = np.broadcast_to(inside, linked.shape)[linked]
        p, q = p[linked], q[linked]
        np.add.at(self.found, q, self.weights[p])
        if self.same:
            np.add.at(self.found, p[~twice], self.weights[q[~twice]])
        x, y = self.groups.root[p], self.groups.root[self.at + q]
        pairs = np.unique(np.stack([x, y], 1)[x != y], axis=0)
        self._hold(pairs[:, 0], pairs[:, 1])

    def _finish(self) -> None:
        for tree, whole, at in ((self.a, self.whole_a, 0), (self.b, self.whole_b, self.at)):
            for node in np.flatnonzero(whole & (tree.high - tree.low > 1)):
                points = tree.members(node)
                self._hold(at + points, np.full(len(points), at + tree.center[node]))
        for node in np.flatnonzero(self.more):
            self.found[self.b.members(node)] += self.more[node]
        self._flush()
