import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import hard_negatives
from pairloom.llm.hyperplane_tree import Tree, distances


def brute(rows, first=5, least=80, most=100):
    sound = [(i, [math.floor(256 * float(np.float32(x))) for x in v], k) for i, v, k in rows if None not in (i, v, k) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, v, k in sound:
        if a % 100:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i, label) for i, w, label in sound if i != a)
        for s, p, _ in [r for r in ranked if r[2] == k][:first]:
            fit = [(n, -t) for t, n, label in ranked if label != k and least * -s <= 100 * -t <= most * -s]
            out += [(a, p, rank, n, -s, t) for rank, (n, t) in enumerate(fit[:first], 1)]
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, leaf int, aid int")
    return sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()))


def near(rng, n, dim, centers, noise, scale=1.0):
    return ((rng.normal(size=(centers, dim))[rng.integers(0, centers, n)] + rng.normal(size=(n, dim)) * noise) * scale).astype("f4").tolist()


@pytest.mark.parametrize(("leaf", "block", "slice_", "group"), [(4096, 1024, 65_536, 4096), (40, 16, 65_536, 3), (15, 8, 10, 5)])
def test_equals_all_pairs(spark, monkeypatch, leaf, block, slice_, group):
    """One leaf or many, slices of leaves, groups of anchors; near copies, equal vectors and vectors of different lengths."""
    for name, value in (("LEAF", leaf), ("BLOCK", block), ("SLICE", slice_), ("GROUP", group)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(leaf)
    vectors = near(rng, 400, 5, 20, 0.3) + near(rng, 200, 5, 1, 0.02) + [[0.5, 0.25, 0.0, 0.0, 0.125]] * 150 + near(rng, 50, 5, 50, 0.1, 4.0)
    rows = [(int(i) * 10, v, int(k)) for i, v, k in zip(rng.permutation(800), vectors, rng.integers(0, 3, 800), strict=True)]
    expected = brute(rows)
    assert len(expected) > 500
    assert found(spark, rows) == expected


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 2.0], 0), (100, [1.0, 2.0], 0), (200, [0.0, 0.0], 0), (300, [], 1), (400, [-1.0, -2.0], 0), (500, None, 0), (600, [1.0, None], 0), (700, [nan, 1.0], 0), (800, [inf, 1.0], 0), (900, [1.0, 1.0], None), (None, [1.0, 2.0], 0)]
    rows += [(1000 + k, [1.0, 2.0 - k / 20], k % 2) for k in range(15)] + [(1100, [0.5], 1), (1200, [1.0] * 3000, 0), (1300, [1.0] * 3000, 1)]
    assert found(spark, rows) == brute(rows)


def test_huge_components(spark):
    rows = [(100, [3.0, 1e12], 0), (1, [1.0, 1e12], 0), (2, [5.0, 0.9e12], 1), (3, [7.0, 1e12], 1), (4, [0.0, 1.1e12], 1)]
    expected = [r for r in brute(rows) if max(map(abs, r[4:])) < 2**63]
    got = found(spark, rows)
    assert [r for r in got if max(map(abs, r[4:])) < 2**63 - 1] == expected  # the others are held at the largest


@pytest.mark.parametrize("rows", [[], [(100, [1.0], 1)], [(100, None, None)], [(100, [1.0], 1), (1, [1.0], 1)]])
def test_few_rows(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_annuli_lose_no_leaf():
    rng = np.random.default_rng(5)
    x = np.array(near(rng, 1500, 4, 30, 0.1))
    tree = Tree(x[:400], 10)
    leaf, met = tree.down(x)
    tree.near, tree.far = ([np.full((len(s), len(s)), end) for s in tree.splits] for end in (np.inf, -np.inf))
    for node, kid, d in met:
        tree.near[node][:, kid] = np.minimum(tree.near[node][:, kid], d.min(0))
        tree.far[node][:, kid] = np.maximum(tree.far[node][:, kid], d.max(0))
    q = np.array(near(rng, 40, 4, 30, 0.5))
    lower, upper = rng.uniform(0, 2, (40, 2)), rng.uniform(0, 0.5, (40, 2))
    upper += lower
    rows, leaves = tree.reached(q, lower, upper, np.full(40, 1e-9))
    asked = set(zip(rows.tolist(), leaves.tolist(), strict=True))
    d = distances(q, x)
    needed = {(i, int(leaf[j])) for w in (0, 1) for i, j in zip(*np.nonzero((d >= lower[:, [w]]) & (d <= upper[:, [w]])), strict=True)}
    assert needed <= asked
    assert len(asked) < 40 * tree.leaves / 2  # and most leaves are left out


def test_anchors_are_stored_once(spark, monkeypatch):
    """An anchor that asks many leaves is a row with sets of them; a row for each would be the whole table times the leaves."""
    tables = []

    def stored(df):
        tables.append(cut(df))
        return tables[-1]

    cut = hard_negatives.cut_lineage
    monkeypatch.setattr(hard_negatives, "cut_lineage", stored)
    monkeypatch.setattr(hard_negatives, "LEAF", 5)
    rng = np.random.default_rng(11)
    rows = [(k * 25, v, k % 3) for k, v in enumerate(near(rng, 1200, 12, 1200, 0.1))]
    assert found(spark, rows) == brute(rows)
    assert max(t.count() for t in tables) <= 5 * 5 * 300  # what 300 anchors get, for five windows each


def test_driver_gets_one_sample(spark, monkeypatch):
    """Whatever the number of tasks, the driver gets one sample, not one from each task."""

    def sent() -> dict[int, int]:
        """Bytes that the driver got, by stage."""
        none = spark._jvm.java.util.ArrayList()
        stages = spark._jsc.sc().statusStore().stageList(none, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), none)
        return {s.stageId(): s.resultSize() for s in map(stages.apply, range(stages.size()))}

    monkeypatch.setattr(hard_negatives, "SAMPLE", 200)
    monkeypatch.setattr(hard_negatives, "LEAF", 4096)
    v = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.rand(3) - 0.5 + k * 0)
    rows = hard_negatives.cut_lineage(spark.range(0, 8000, 1, 40).select(F.col("id").alias("vec_id"), v.cast("array<float>").alias("embedding"), (F.col("id") % 3).alias("label")))
    monkeypatch.setattr(hard_negatives.Index, "search", lambda index, anchors, k, same: spark.createDataFrame([], "aid long, window int, vec_id long, score long, rank int"))
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task for each file
    try:
        before = sent()
        hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)
        assert 0 < max(n for stage, n in sent().items() if stage not in before) < 1 << 20
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize(("flood", "asking"), [(40, 7), (1000, 100)])
def test_floods_of_ties(spark, monkeypatch, flood, asking):
    """Hot groups of equal vectors, in leaves of many slices, of few and of many labels, and rows of one id."""
    for name, value in (("FLOOD", flood), ("ASKING", asking), ("TOGETHER", asking), ("LEAF", 20), ("SLICE", 60), ("BLOCK", 16), ("GROUP", 9)):
        monkeypatch.setattr(hard_negatives, name, value)
    monkeypatch.setattr(hard_negatives, "bound_batches", lambda session: None)
    rng = np.random.default_rng(3)
    vectors = [[0.5, -0.25, 0.125]] * 300 + [[0.25, 0.5, -1.0]] * 100 + near(rng, 200, 3, 10, 0.05)
    ids = [int(i) * 20 for i in rng.permutation(590)] + [100] * 10
    rows = [(i, v, k % 2 if k < 250 else k) for k, (i, v) in enumerate(zip(ids, vectors, strict=True))]
    assert found(spark, rows) == brute(rows)


def test_slice_sifts_ties(monkeypatch):
    """A slice gives what may be among the first of a window, whether few or many reach it, as floats and as doubles."""
    rng = np.random.default_rng(8)
    for kind, flood in (("i2", 10), ("i2", 1 << 20), ("f8", 10)):
        monkeypatch.setattr(hard_negatives, "FLOOD", flood)
        x, ids, labels = rng.integers(-2, 3, (500, 3)), rng.permutation(500), rng.integers(0, 3, 500).astype(str)
        blocks = [hard_negatives._batch({"slice": [0], "cell": [c], "ids": [ids[c::4].tobytes()], "labels": [labels[c::4].tolist()], "v": [x[c::4].astype(kind).tobytes()]}, hard_negatives._BLOCK) for c in range(4)]
        v, low, high = rng.integers(-2, 3, (9, 3)), np.array([[-4, 0]] * 9), np.array([[3, 2]] * 9)
        anchors = {"aid": range(9), "anchor_id": range(9), "label": labels[:9].tolist(), "v": [r.astype(kind).tobytes() for r in v], "low": [r.tobytes() for r in low], "high": [r.tobytes() for r in high], "cell": [15] * 9}
        for same in (True, False):
            got = hard_negatives.Slice(blocks, 3, kind, 4, same).first(hard_negatives._batch(anchors, "aid long, anchor_id long, label string, v binary, low binary, high binary, cell long"))
            rows = {a: {tuple(p) for p in np.frombuffer(f, np.int64).reshape(-1, 2).tolist()} for a, f in zip(*(c.to_pylist() for c in got.columns), strict=True)}
            for a in range(9):
                scored = sorted((-int(s), int(i)) for s, i, k in zip(x @ v[a], ids, labels, strict=True) if i != a and (k == labels[a]) == same)
                first = {(i, -s) for lo, hi in zip(low[a], high[a], strict=True) for s, i in [p for p in scored if lo <= -p[0] <= hi][:4]}
                assert rows.get(a, set()) == first
