import math

import pytest

from pairloom.operators.fallback import FallbackSettings, merge_fallback
from pairloom.operators.scoring import Scorer
from pairloom.operators.topk import TopK
from pairloom.schemas import RAW_COUNTS

AGG = "item_id long, similar_item_id long, pair_count long, view_count long, click_count long, favorite_count long, to_cart_count long, unique_users long, unique_sessions long"


def aggregates(spark, *rows):
    return spark.createDataFrame(list(rows), AGG)


def test_calibrated_score(spark):
    shares = {"view": 0.80, "click": 0.10, "favorite": 0.06, "to_cart": 0.04}
    df = aggregates(spark, (1, 2, 100, 100, 0, 0, 0, 9, 9), (1, 3, 1, 0, 0, 0, 1, 9, 9))
    got = {r["similar_item_id"]: r["score"] for r in Scorer(action_shares=shares).score(df).collect()}
    assert got[2] == pytest.approx(math.log(101))
    assert got[3] == pytest.approx(8 * math.sqrt(20) * math.log(2))


@pytest.mark.parametrize(("transform", "expected"), [("log", math.log(3.5)), ("linear", 2.5), ("sqrt", math.sqrt(2.5))])
def test_transforms_of_weighted_counts(spark, transform, expected):
    from pyspark.sql import functions as F

    df = aggregates(spark, (1, 2, 3, 3, 0, 0, 0, 1, 1)).withColumns({f"weighted_{c}": F.lit(2.5 if c in ("pair_count", "view_count") else 0.0) for c in RAW_COUNTS})
    scorer = Scorer(count_source="weighted", count_transform=transform, business_weights={"view": 1.0})
    assert scorer.score(df).first()["score"] == pytest.approx(expected)


def test_thresholds_and_normalisation(spark):
    df = aggregates(spark, (1, 2, 4, 4, 0, 0, 0, 2, 2), (1, 3, 1, 1, 0, 0, 0, 1, 1))
    assert Scorer(min_pair_count=2).score(df).count() == 1
    popularity = spark.createDataFrame([(1, 3), (2, 8)], "item_id long, unique_users long")
    got = {r["similar_item_id"]: r["score"] for r in Scorer(method="pair_count", normalize_by_popularity=True).score(df, popularity).collect()}
    assert got[2] == pytest.approx(4 / math.sqrt(4 * 9))
    assert got[3] is None
    assert Scorer(method="pair_count", min_score=2.0).score(df).count() == 1
    with pytest.raises(ValueError, match="popularity"):
        Scorer(normalize_by_popularity=True).score(df)


@pytest.mark.parametrize("bad", [{"method": "x"}, {"count_source": "x"}, {"count_transform": "x"}, {"smoothing": 0}, {"beta": -1}, {"min_pair_count": -1}])
def test_scorer_guards(bad):
    with pytest.raises(ValueError):
        Scorer(**bad)


def test_topk_ties_self_nulls_and_duplicates(spark):
    from pyspark.sql import functions as F

    df = aggregates(spark, (1, 4, 3, 0, 0, 0, 0, 1, 1), (1, 3, 3, 0, 0, 0, 0, 1, 1), (1, 1, 9, 0, 0, 0, 0, 1, 1), (2, 5, 5, 0, 0, 0, 0, 1, 1), (2, 5, 9, 0, 0, 0, 0, 1, 1), (None, 5, 9, 0, 0, 0, 0, 1, 1)).withColumn("score", F.col("pair_count").cast("double"))
    rows = TopK(top_k=2).select(df).orderBy("item_id", "rank").collect()
    assert [(r["item_id"], r["similar_item_id"], r["rank"], r["score"]) for r in rows] == [(1, 3, 1, 3.0), (1, 4, 2, 3.0), (2, 5, 1, 9.0)]
    with pytest.raises(ValueError, match="positive"):
        TopK(top_k=0)


POP = "item_id long, events_count long, unique_users long, views_count long, clicks_count long, favorites_count long, to_cart_count long"
PROD = "item_id long, name string, brand string, type string, category_id long, category_name string"


def test_cascade(spark):
    base = spark.createDataFrame([(1, 2, 9.0, 1, "behavioral")], "item_id long, similar_item_id long, score double, rank long, source string")
    popularity = spark.createDataFrame([(i, 100 - i, 100 - i, 0, 0, 0, 0) for i in range(1, 8)], POP)
    products = spark.createDataFrame([(1, "a", "b", "t", 1, "c"), (2, "a", "b", "t", 1, "c"), (3, "a", "x", "t", 1, "c"), (4, "a", "x", "u", 1, "c"), (5, "a", "x", "t", 2, "c"), (6, "a", "y", "z", 3, "c"), (7, "a", "y", "z", 3, "c")], PROD)
    rows = merge_fallback(base, popularity, products, FallbackSettings(enabled=True, top_k=5)).filter("item_id = 1").orderBy("rank").collect()
    assert [r["similar_item_id"] for r in rows] == [2, 3, 4, 5, 6]
    assert [r["source"] for r in rows] == ["behavioral", "fallback_category_type_popular", "fallback_category_popular", "fallback_type_popular", "fallback_global_popular"]
    assert [r["score"] for r in rows] == [9.0, 0.0, 0.0, 0.0, 0.0]
    cold = merge_fallback(base, popularity, products, FallbackSettings(enabled=True, top_k=5, include_cold_start_items=False))
    assert {r["item_id"] for r in cold.collect()} == {1}
    assert merge_fallback(base, popularity.limit(0), products, FallbackSettings(enabled=True)).collect() == base.collect()
    assert merge_fallback(base, popularity, None, FallbackSettings(enabled=True, top_k=3)).filter("item_id = 1").count() == 3
    assert merge_fallback(base, popularity, None, FallbackSettings(enabled=True, enable_global=False)).collect() == base.collect()
    with pytest.raises(ValueError, match="positive"):
        FallbackSettings(top_k=0)


def test_cascade_against_a_walk(spark):
    import random

    rnd = random.Random(2)
    for _ in range(4):
        n, k = 14, rnd.choice([2, 4, 6])
        pop = [(i, rnd.randint(1, 5), rnd.randint(1, 3), 0, 0, 0, rnd.randint(0, 1)) for i in range(n)]
        meta = {i: (rnd.choice("ab"), rnd.choice("tu"), rnd.choice([1, 2, None])) for i in range(n)}
        base = [(i, j, 1.0, r + 1, "behavioral") for i in range(0, n, 2) for r, j in enumerate(rnd.sample([x for x in range(n) if x != i], rnd.randint(0, 3)))]
        settings = FallbackSettings(enabled=True, top_k=k, enable_brand=True)
        got = merge_fallback(
            spark.createDataFrame(base, "item_id long, similar_item_id long, score double, rank long, source string"), spark.createDataFrame(pop, POP),
            spark.createDataFrame([(i, "n", b, t, c, "c") for i, (b, t, c) in meta.items()], PROD), settings,
        )
        order = [p[0] for p in sorted(pop, key=lambda p: (-p[2], -p[6], -p[5], -p[4], -p[3], -p[1], p[0]))]
        expected = []
        for i in range(n):
            mine = [(j, s) for a, j, _, _, s in base if a == i][:k]
            b, t, c = meta[i]
            tests = [("category_type", lambda m: c is not None and m[2] == c and m[1] == t), ("category", lambda m: c is not None and m[2] == c), ("type", lambda m: m[1] == t), ("brand", lambda m: m[0] == b), ("global", lambda m: True)]
            for level, fits in tests:
                for j in order:
                    if len(mine) < k and j != i and j not in {x for x, _ in mine} and fits(meta[j]):
                        mine.append((j, f"fallback_{level}_popular"))
            expected += [(i, r + 1, j, s) for r, (j, s) in enumerate(mine)]
        assert sorted((r["item_id"], r["rank"], r["similar_item_id"], r["source"]) for r in got.collect()) == sorted(expected)
