import pytest
from helpers import clean
from test_artifacts import random_events
from test_runs import CONFIG, products

from pairloom.config import Settings, override
from pairloom.plans import tuning
from pairloom.plans.recommend import recommend, validation_truth
from pairloom.plans.trials import evaluate_trials

BASE = override(CONFIG, {"pipeline.lookback_days": 2, "pipeline.session_timeout_minutes": 300, "evaluation.relevance_mode": "graded"})
GRID = {
    "scoring.beta": {"values": [0.0, 0.8]},
    "scoring.normalize_by_item_popularity": {"values": [False, True]},
    "scoring.min_unique_users": {"values": [1, 2]},
    "topk.top_k": {"values": [1, 4]},
    "business.fallback.enable_global": {"values": [True, False]},
}


@pytest.fixture(scope="module")
def tables(spark):
    events = clean(spark, random_events(4, users=30, items=15))
    plan = recommend(events, products(spark), Settings.from_config(BASE), "2024-03-02")
    return plan, validation_truth(events, BASE, "2024-03-02", 1), events


def test_one_pass_gives_what_single_trials_give(spark, tables):
    plan, truth, _ = tables
    params = list(tuning.grid(GRID))[::3] + [{"scoring.min_score": 3.0}, {"scoring.method": "pair_count", "topk.min_pair_count": 3}, {"scoring.min_pair_count": 10_000}, {"business.fallback.enabled": False}, {"scoring.popularity_normalization.popularity_column": "events_count", "scoring.normalize_by_item_popularity": True}]
    single = tuning.scoring_trials(plan.clean, plan.sessions, plan.popularity, plan.distribution, plan.aggregates, products(spark), truth, BASE)
    several = evaluate_trials(plan.aggregates, plan.popularity, plan.distribution, products(spark), truth, BASE, params)
    assert len(several) == len(params)
    for p, found in zip(params[::3] + params[-5:], [*several[::3], *several[-5:]], strict=True):
        assert found.as_dict() == pytest.approx(single(p), nan_ok=True), p
    assert len({m.ndcg_at_k for m in several}) > 5


def test_sweeps_use_it(spark, tables, tmp_path):
    space = {"scoring.beta": {"type": "float_range", "min": 0.0, "max": 1.0, "step": 0.5}, "topk.top_k": {"values": [2, 3]}}
    asked = {"space": space, "objective": {"primary": "ndcg_at_k"}, "method": "grid"}
    top = tuning.tune(tables[2], products(spark), BASE, asked, "2024-03-02", 1, f"{tmp_path}/sweep")
    assert top["objective"] > 0
    assert len(tuning.recover(f"{tmp_path}/sweep", asked["objective"]).results) == 6
