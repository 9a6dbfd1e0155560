import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairloom.llm import mixing


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(5)
    rows = [(i, None if rnd.random() < 0.03 else " ".join("w" * rnd.randint(1, 4) for _ in range(rnd.randint(0, 30))), rnd.choices(["a", "b", "c", None, ""], [60, 20, 10, 5, 5])[0]) for i in range(2000)]
    rows += [(10000, "", "empty"), (10001, None, "empty"), *[rows[5]] * 3]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("weight", F.lit(1)).cache()


def of(row):
    return row["source"]


def words(row):
    return len((row["text"] or "").split())


@pytest.mark.parametrize("limit", [1.0, 1.5, 3.0])
def test_repetition_limit(docs, monkeypatch, limit):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 20)
    plan = {(r["_s"], r["_no"]): r for r in mixing.plan(docs, repetition_limit=limit).collect()}
    rows, whole = mixing.mix(docs, repetition_limit=limit).collect(), docs.collect()
    there, got, taken = Counter(), Counter(), Counter((r["doc_id"], r["source"]) for r in rows)
    for r in whole:
        there[of(r)] += words(r)
    for r in rows:
        got[of(r)] += words(r)
    assert set(taken) == {(r["doc_id"], r["source"]) for r in whole}  # nothing is left out
    for s, n in there.items():
        p = plan[s or "", s is None]
        assert p["tokens"] == n
        if n:
            assert n <= p["budget"] <= math.ceil(limit * n * (1 + 1e-4))
            assert p["budget"] - 120 <= got[s] <= p["budget"]
    assert sum(p["weight"] for p in plan.values()) == pytest.approx(1)
    assert all(0 <= r["place"] <= 1 and r["epoch"] >= 1 for r in rows)
    again = sorted((r["doc_id"], r["epoch"], r["place"]) for r in mixing.mix(docs.repartition(3), repetition_limit=limit).collect())
    assert again == sorted((r["doc_id"], r["epoch"], r["place"]) for r in rows)


def test_against_a_plain_computation(spark, docs):
    """Exponent by fine bisection over the shares, budgets, and rows in the order of the same places."""
    rows = docs.withColumn("at", mixing._place(docs, mixing.SEED)).collect()
    total = Counter()
    for r in rows:
        total[of(r)] += words(r)
    p = {s: n / sum(total.values()) for s, n in total.items() if n}
    low, high = 0.0, 1.0
    for _ in range(60):
        a = (low + high) / 2
        ratios = [x ** (a - 1) for x in p.values()]
        low, high = (low, a) if max(ratios) <= mixing.REPETITION_LIMIT * min(ratios) else (a, high)
    least = min(x ** (high - 1) for x in p.values())
    budget = {s: round(total[s] * p[s] ** (high - 1) / least) if s in p else 0 for s in total}
    got = {(r["_s"], r["_no"]): r["budget"] for r in mixing.plan(docs).collect()}
    for s, n in budget.items():  # the exponent is found to a step of 16 ** -5
        assert got[s or "", s is None] == pytest.approx(n, rel=1e-4, abs=1)
    want = Counter()
    for s in total:
        own, left = sorted((r for r in rows if of(r) == s), key=lambda r: r["at"]), got[s or "", s is None]
        epochs, rest = divmod(left, total[s]) if total[s] else (1, 0)
        cut, used = 0, 0  # rows of a place go together, as long as the budget reaches beyond them
        for at in sorted({r["at"] for r in own}):
            n = sum(words(r) for r in own if r["at"] == at)
            if used <= rest < used + n:
                cut = at
                break
            used += n
        for r in own:
            want[r["doc_id"], s] += epochs + (r["at"] < cut)
    assert Counter((r["doc_id"], r["source"]) for r in mixing.mix(docs).collect()) == +want


def test_target_entropy_and_total(docs):
    plan = mixing.plan(docs, repetition_limit=None, entropy=1.3, total_tokens=5000).collect()
    assert -sum(p["weight"] * math.log(p["weight"]) for p in plan if p["weight"]) == pytest.approx(1.3, abs=1e-4)
    rows = mixing.mix(docs, repetition_limit=None, entropy=1.3, total_tokens=5000).collect()
    assert 5000 - 200 <= sum(map(words, rows)) <= 5003
    with pytest.raises(ValueError, match="needed"):
        mixing.plan(docs, repetition_limit=None)


def test_joins_without_broadcast_agree(docs, monkeypatch):
    key = lambda rows: sorted((r["doc_id"], r["epoch"]) for r in rows)
    few = key(mixing.mix(docs).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert key(mixing.mix(docs).collect()) == few


def test_odd_rows(spark, odd):
    rows = mixing.mix(odd.withColumn("source", F.lit(None).cast("string"))).collect()
    assert len(rows) == odd.count()
    assert mixing.mix(odd.limit(0)).count() == 0
    none = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert mixing.mix(none).count() == 2


def test_no_python_on_the_way(odd):
    assert "Python" not in mixing.mix(odd)._jdf.queryExecution().toString()
