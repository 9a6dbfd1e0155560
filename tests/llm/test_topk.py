import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import topk


def brute(rows, k=10):
    sound = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in sound:
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in sound if i != q)[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, score int, rank int")
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 100 == 0).collect()))


def test_ties_nulls_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(0, 1 + i % 7, 8).astype("f4").tolist()) for i in range(700)]
    rows += [(700 + i, rows[0][1]) for i in range(40)]
    rows += [(800, None), (900, [1.0, None] + [0.0] * 6), (1000, [float("nan")] * 8), (1001, [float("inf")] * 8), (1100, []), (1200, [1.0, 2.0]), (1300, [0.0] * 8), (None, [1.0] * 8)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(100, [1.0])], [(100, [1.0, 2.0]), (3, [1.0, 1.0])], [(i * 100, [1.0] * 4) for i in range(15)]])
def test_few_vectors(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_blocks_of_very_different_lengths(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(0, 1, 32) * rng.choice([0.1, 1, 50])).astype("f4").tolist()) for i in range(1500)]
    assert found(spark, rows) == brute(rows)


def test_products_beyond_64_bits_are_held():
    a = np.array([[2**40, 2**40]], np.int64)
    assert topk.products(a, a)[0] == 2**63 - 1
    assert topk.products(a, -a)[0] == -(2**63)


def test_query(spark):
    import os

    from .conftest import DATA

    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    assert sorted(map(tuple, topk.op6_topk(spark, DATA).collect())) == brute(rows)
