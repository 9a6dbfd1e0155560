import math

import pytest

from pairloom.operators.evaluation import Scorecard, TemporalSplit, ground_truth, offline_metrics, ranking_truth, split_train_validation

RECS = "item_id long, similar_item_id long, score double, rank long, source string"
TRUTH = "item_id long, relevant_item_id long, relevance double, target_action_type string, evidence_count long, view_count long, click_count long, favorite_count long, to_cart_count long"


def test_view_hits_are_not_ranking_hits(spark):
    recs = spark.createDataFrame([(1, 2, 2.0, 1, "behavioral"), (1, 3, 1.0, 2, "behavioral")], RECS)
    truth = spark.createDataFrame([(1, 2, 0.1, "view", 1, 1, 0, 0, 0), (1, 3, 1.0, "click", 1, 0, 1, 0, 0)], TRUTH)
    m = offline_metrics(recs, truth, 2)
    assert m.mrr_at_k == 0.5
    assert m.ndcg_at_k == pytest.approx(1 / math.log2(3))
    assert (m.view_hit_rate_at_k, m.view_only_ground_truth_pairs, m.ranking_ground_truth_pairs, m.ground_truth_pairs) == (1.0, 1, 1, 2)


def test_shares_and_recall(spark):
    recs = spark.createDataFrame([(1, 2, 2.0, 1, "behavioral"), (1, 3, 0.0, 2, "fallback_global_popular"), (4, 5, 1.0, 1, "behavioral")], RECS)
    truth = spark.createDataFrame([(1, 2, 1.0, "to_cart", 1, 0, 0, 0, 1), (1, 9, 1.0, "to_cart", 1, 0, 0, 0, 1), (4, 5, 1.0, "click", 1, 0, 1, 0, 0)], TRUTH)
    popularity = spark.createDataFrame([(2, 4), (3, 2), (5, 4)], "item_id long, unique_users long")
    m = offline_metrics(recs, truth, 2, popularity)
    assert (m.hit_rate_at_k, m.recall_at_k, m.coverage_at_k) == (1.0, 0.75, 1.0)
    assert m.fallback_share_at_k == pytest.approx(1 / 3)
    assert (m.fallback_hit_rate_at_k, m.fallback_recall_at_k) == (0.0, 0.0)
    assert m.popularity_bias_at_k == pytest.approx((4 + 2 + 4) / 3 / 4)


def test_no_truth_gives_nulls(spark):
    m = offline_metrics(spark.createDataFrame([], RECS), spark.createDataFrame([], TRUTH), 5)
    assert (m.hit_rate_at_k, m.coverage_at_k, m.evaluated_items) == (None, None, 0)


def test_graded_truth(spark):
    counts = spark.createDataFrame([("2024-03-01", 1, 2, 5, 3, 1, 0, 1)], "pair_date string, item_id long, similar_item_id long, pair_count long, view_count long, click_count long, favorite_count long, to_cart_count long")
    row = ground_truth(counts, "graded").first()
    assert row["relevance"] == pytest.approx(1.6)
    assert row["target_action_type"] == "to_cart"
    assert ground_truth(counts, min_relevance=1.0).count() == 0
    with pytest.raises(ValueError, match="mode"):
        ground_truth(counts, "other")


def test_ranking_filter(spark):
    truth = spark.createDataFrame([(1, 2, 0.5, "favorite", 1, 0, 0, 1, 0), (1, 3, 0.5, "view", 1, 5, 0, 0, 0)], TRUTH)
    assert ranking_truth(truth, [], None).count() == 0
    assert ranking_truth(truth, [], 0.3).count() == 1
    with pytest.raises(ValueError, match="negative"):
        ranking_truth(truth, None, -1)


def test_split(spark):
    df = spark.createDataFrame([("2024-03-01",), ("2024-03-02",), ("2024-03-03",), ("bad",), (None,)], "event_date string")
    train, valid = split_train_validation(df, TemporalSplit("2024-03-01", "2024-03-02", "2024-03-02"))
    assert (train.count(), valid.count()) == (1, 1)
    with pytest.raises(ValueError, match="before"):
        TemporalSplit("2024-03-02", "2024-03-02", "2024-03-03")


def test_scorecard():
    with pytest.raises(ValueError):
        Scorecard(" ", "2024-03-01", 1, 1, {})


def test_coverage_is_of_ranking_truth(spark):
    """Items with only views as truth, and lists of items without truth, count for neither."""
    recs = spark.createDataFrame([(1, 2, 2.0, 1, "behavioral"), (4, 5, 1.0, 1, "behavioral"), (7, 8, 1.0, 1, "behavioral"), (9, 1, 1.0, 3, "behavioral")], RECS)
    truth = spark.createDataFrame([(1, 2, 1.0, "click", 1, 0, 1, 0, 0), (4, 5, 0.1, "view", 1, 1, 0, 0, 0), (6, 5, 1.0, "click", 1, 0, 1, 0, 0), (9, 1, 1.0, "click", 1, 0, 1, 0, 0)], TRUTH)
    m = offline_metrics(recs, truth, 2)
    assert m.coverage_at_k == pytest.approx(1 / 3)
    assert (m.recommended_items, m.ranking_evaluated_items, m.all_evaluated_items) == (1, 3, 4)
