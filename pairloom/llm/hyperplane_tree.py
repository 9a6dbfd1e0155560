"""Multiway hyperplane tree with distance ranges (a geometric near-neighbour access tree).

A node has split points, and a point belongs to the child of the nearest one. For each child, a node keeps the least and
largest distance of its points to every split point, its siblings' too. A search for points within an annulus around a
query computes the distances to a node's split points once; a child is left out if for one of them its range doesn't meet
what the triangle inequality allows in the annulus.
"""

from __future__ import annotations

import numpy as np

#: Split points of a node; they are the farthest of so many times as many candidates.
FAN_OUT, CANDIDATES = 12, 3
#: Queries that go down together.
TOGETHER = 256


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)))


class Tree:
    """``splits[node]``: its split points; ``kids[node]``: for each, a node from 0 or, as -1 - number, a leaf."""

    def __init__(self, sample: np.ndarray, leaf_size: int) -> None:
        self.splits: list[np.ndarray] = []
        self.kids: list[np.ndarray] = []
        self.leaves = 0
        self.top = self._build(sample, max(leaf_size, 2))
        self.near = [np.zeros((len(s), len(s))) for s in self.splits]
        self.far = [np.full((len(s), len(s)), np.inf) for s in self.splits]

    def _build(self, sample: np.ndarray, leaf_size: int) -> int:
        picked = self._picked(sample) if len(sample) > leaf_size else sample[:0]
        if len(picked) < 2:  # few points, or all equal
            self.leaves += 1
            return -self.leaves
        node, of = len(self.splits), distances(sample, picked).argmin(1)
        self.splits.append(picked)
        self.kids.append(np.zeros(len(picked), int))
        for k in range(len(picked)):
            self.kids[node][k] = self._build(sample[of == k], leaf_size)
        return node

    @staticmethod
    def _picked(sample: np.ndarray) -> np.ndarray:
        some = sample[: FAN_OUT * CANDIDATES]
        picked = [0]
        far = distances(some[:1], some)[0]
        tiny = 1e-6 * (1 + np.sqrt((some * some).sum(1).max()))
        while len(picked) < FAN_OUT and far.max() > tiny:
            picked.append(int(far.argmax()))
            far = np.minimum(far, distances(some[picked[-1:]], some)[0])
        return some[picked]

    def down(self, x: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray]]]:
        """Leaf of each point, and (node, child, distances to the node's split points) of the points of each child."""
        leaf, met, todo = np.zeros(len(x), int), [], [(self.top, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                leaf[rows] = -1 - node
                continue
            d = distances(x[rows], self.splits[node])
            of = d.argmin(1)
            order = np.argsort(of, kind="stable")
            rows, d = rows[order], d[order]
            ends = np.searchsorted(of[order], np.arange(len(self.kids[node]) + 1))
            for k in np.flatnonzero(np.diff(ends)).tolist():
                mine = slice(ends[k], ends[k + 1])
                met.append((node, k, d[mine]))
                todo.append((int(self.kids[node][k]), rows[mine]))
        return leaf, met

    def reached(self, x: np.ndarray, near: np.ndarray, far: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) where a point may be within one of a query's annuli: ``near`` to ``far`` (query, annulus); once for each at most."""
        rows_of, leaves_of = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        query, annulus = (a.astype(np.int32) for a in np.nonzero(near <= far))
        near, far, slack = near[query, annulus], far[query, annulus], slack[query]
        todo = [(self.top, np.arange(at, min(at + TOGETHER, len(query)))) for at in range(0, len(query), TOGETHER)]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                rows_of.append(query[rows])
                leaves_of.append(np.full(len(rows), -1 - node, np.int32))
                continue
            d = distances(self.splits[node], x[query[rows]])  # (split point, annulus)
            low = np.maximum(np.maximum(d - far[rows], near[rows] - d), 0) - slack[rows]
            high = d + (far + slack)[rows]
            for k in range(len(self.kids[node])):
                meets = ((self.far[node][:, k, None] >= low) & (self.near[node][:, k, None] <= high)).all(0)
                if meets.any():
                    todo.append((int(self.kids[node][k]), rows[meets]))
        return np.concatenate(rows_of), np.concatenate(leaves_of)
