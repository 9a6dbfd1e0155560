import math

import numpy as np
import pytest

from pairloom.llm import embedding_dedup
from pairloom.llm.cover_tree import CoverTree, Links


def brute(rows, least=0.93):
    """(id, links, class, kept) of (id, vector, label) rows; rows of one id share their class."""

    def sound(r):
        return None not in (r[0], r[1], r[2]) and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    links, root = [0] * len(rows), {r[0]: r[0] for r in rows if r[0] is not None}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    width = max([len(r[1]) for r in rows if r[1]], default=1)
    wide = [np.array([*map(np.float64, r[1]), *[0.0] * (width - len(r[1]))]) if sound(r) else None for r in rows]
    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if wide[i] is not None and wide[j] is not None and a[2] == b[2]:
                u, v = (x / np.abs(x).max() for x in (wide[i], wide[j]))
                if u @ v / math.sqrt(u @ u) / math.sqrt(v @ v) >= least:
                    links[i] += 1
                    links[j] += 1
                    x, y = top(a[0]), top(b[0])
                    root[max(x, y)] = min(x, y)
    return sorted(((r[0], n, None if r[0] is None else top(r[0]), r[0] is None or r[0] == top(r[0])) for r, n in zip(rows, links, strict=True)), key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<float>, label int, gid int, cell int, n int")
    return sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()), key=repr)


def near(rng, n, dim, centers, noise):
    x = rng.normal(size=(centers, dim))[rng.integers(0, centers, n)] + rng.normal(size=(n, dim)) * noise
    return x.astype("f4").tolist()


@pytest.mark.parametrize(("cell", "block", "batch"), [(4096, 16384, 4096), (40, 16384, 4096), (15, 20, 7)])
def test_equals_all_pairs(spark, monkeypatch, cell, block, batch):
    """One cell a label or many, blocks of a cell, batches of visitors, a hot group of near copies and one of equal vectors."""
    for name, value in (("CELL", cell), ("BLOCK", block), ("BATCH", batch)):
        monkeypatch.setattr(embedding_dedup, name, value)
    rng = np.random.default_rng(cell)
    vectors = near(rng, 150, 6, 60, 0.15) + near(rng, 150, 6, 1, 0.02) + [[1.0, 0.0, 0.0, 0.0, 0.0, 0.5]] * 100
    rows = [(int(i), v, int(k)) for i, v, k in zip(rng.permutation(5000), vectors, rng.integers(0, 3, 400), strict=False)]
    rows += [(9000 + i, v, 100 + i) for i, v in enumerate(near(rng, 20, 6, 5, 0.1))]  # labels of one vector
    assert found(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [1.0, 2.0], 1), (3, [2.0, 4.0], 0), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0), (7, [1.0, None], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0)]
    rows += [(10, [1.0, 2.0], None), (None, [1.0, 2.0], 0), (11, [1.0], 0), (12, [3.0, 0.0], 0), (13, [3e38, 1e38], 5), (14, [3e-38, 1e-38], 5), (15, [-1.0, -2.0], 0), (1, [-1.0, -2.0], 0), (-7, [0.5, 1.0], 0), (16, [1.0] * 4000, 7)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(5, [1.0], 1)], [(5, None, None)]])
def test_few_rows(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_traversal_of_two_trees():
    rng = np.random.default_rng(1)
    for dim, n, centers, noise in [(1, 50, 3, 0.0), (3, 300, 20, 0.1), (8, 400, 10, 0.2), (5, 200, 200, 1.0), (4, 100, 1, 1e-9), (4, 0, 1, 0)]:
        x = np.array(near(rng, n, dim, centers, noise)).reshape(n, dim)
        x /= np.sqrt((x * x).sum(1, keepdims=True))
        weights, half = rng.integers(1, 5, n), n // 2
        linked = (x @ x.T) >= 0.93
        across = linked[:half, half:].copy()
        np.fill_diagonal(linked, False)
        assert (Links(CoverTree(x), weights, None, 0.93).found == weights @ linked).all()
        assert (Links(CoverTree(x[:half]), weights[:half], CoverTree(x[half:]), 0.93).found == weights[:half] @ across).all()


def test_tree_levels_cover_and_separate():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    tree = CoverTree(x)
    assert sorted(tree.order) == list(range(500))
    for node in range(len(tree.center)):
        far = np.sqrt(((x[tree.members(node)] - x[tree.center[node]]) ** 2).sum(1))
        assert far.max() <= tree.radius[node] + 1e-6
        kids = tree.below(node)
        if len(kids) > 1:
            d = np.sqrt(((x[tree.center[kids]][:, None] - x[tree.center[kids]]) ** 2).sum(2))
            assert d[~np.eye(len(kids), dtype=bool)].min() > tree.radius[kids].max() - 1e-6
            assert sorted(np.concatenate([tree.members(k) for k in kids])) == sorted(tree.members(node))
