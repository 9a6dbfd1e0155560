import random
import shutil

import pytest
from helpers import clean, same_rows, ts
from test_runs import CONFIG, products, raw

from pairloom.config import Settings, override
from pairloom.operators.aggregate import aggregate_window
from pairloom.operators.pairs import Support, item_pairs, session_items, supported_items
from pairloom.operators.scoring import Scorer
from pairloom.operators.sessions import build_sessions
from pairloom.plans.artifacts import Catalogue
from pairloom.plans.recommend import run, score
from pairloom.sources.events import scan_events

COLUMNS = ("item_id", "similar_item_id", "score", "rank", "source")


def random_events(seed=1, users=15, items=12):
    r = random.Random(seed)
    return [(u, ts(day, f"{r.randrange(24):02}:{r.randrange(60):02}"), r.choice(["view", "click", "to_cart"]), int(items * r.random() ** 2)) for u in range(users) for day in (1, 2, 3) for _ in range(r.randrange(9))]


def write_events(spark, folder, rows):
    raw(spark, rows).write.mode("overwrite").partitionBy("date", "action_type").parquet(folder)
    return scan_events(spark, folder)


def lists(spark, result):
    return [tuple(r) for r in spark.read.parquet(f"{result.output_dir}/detailed.parquet").select(*COLUMNS).collect()]


def test_scores_from_artifacts_need_no_events(spark, tmp_path):
    """Other parameters of the last steps, from the catalogue alone, give what a full run gives."""
    events = write_events(spark, f"{tmp_path}/events", random_events())
    base = override(CONFIG, {"pipeline.lookback_days": 3, "pipeline.session_timeout_minutes": 120})
    other = override(base, {"scoring.beta": 0.9, "scoring.min_unique_users": 2, "scoring.normalize_by_item_popularity": True, "topk.top_k": 2, "business.fallback.top_k": 4})
    run(events, products(spark), base, "2024-03-03", f"{tmp_path}/out", "first")
    expected = lists(spark, run(events, products(spark), other, "2024-03-03", f"{tmp_path}/full", "full"))
    shutil.rmtree(f"{tmp_path}/events")
    result = score(f"{tmp_path}/out/_artifacts", products(spark), other, "2024-03-03", f"{tmp_path}/out", "second", latest_dir=f"{tmp_path}/latest")
    same_rows(lists(spark, result), COLUMNS, expected, COLUMNS)
    assert result.rows == len(expected)
    assert (tmp_path / "out/second/lookup.parquet").exists() and (tmp_path / "latest/manifest.json").exists()
    for change in ({"pipeline.session_timeout_minutes": 60}, {"pipeline.lookback_days": 2}, {"graph.time_decay.enabled": True}):
        with pytest.raises(FileNotFoundError, match="pair_aggregates"):
            score(f"{tmp_path}/out/_artifacts", None, override(base, change), "2024-03-03", f"{tmp_path}/out", "third")
    shutil.rmtree(f"{tmp_path}/out/first/item_popularity.parquet")
    with pytest.raises(FileNotFoundError, match="item_popularity"):
        score(f"{tmp_path}/out/_artifacts", None, base, "2024-03-03", f"{tmp_path}/out", "fourth")


def test_runs_reuse_tables_of_the_same_files_only(spark, tmp_path):
    events = write_events(spark, f"{tmp_path}/events", random_events())
    config = override(CONFIG, {"pipeline.lookback_days": 3, "pipeline.reuse_artifacts": True})
    first = run(events, None, config, "2024-03-03", f"{tmp_path}/out", "a")
    again = run(events, None, override(config, {"scoring.min_pair_count": 2}), "2024-03-03", f"{tmp_path}/out", "b")
    assert not (tmp_path / "out/b/pair_aggregates.parquet").exists()
    assert 0 < again.rows <= first.rows
    changed = write_events(spark, f"{tmp_path}/events", random_events(2))
    run(changed, None, config, "2024-03-03", f"{tmp_path}/out", "c")
    assert (tmp_path / "out/c/pair_aggregates.parquet").exists()  # the files are others
    entry = Catalogue(f"{tmp_path}/out/_artifacts").find("pair_aggregates", ("2024-03-01", "2024-03-03"), Settings.from_config(config))
    assert entry.path.endswith("/c/pair_aggregates.parquet")


def test_working_tables_are_deleted(spark, tmp_path):
    before = set_of_staged(spark)
    run(write_events(spark, f"{tmp_path}/events", random_events()), products(spark), CONFIG, "2024-03-02", f"{tmp_path}/out", "a", validation_days=1)
    assert set_of_staged(spark) == before


def set_of_staged(spark):
    from pairloom.sources.files import folders

    return {f for f in folders(spark.sparkContext.getConf().get("spark.checkpoint.dir")) if f.startswith("staged-")}


@pytest.mark.parametrize("thresholds", [{"min_unique_sessions": 3}, {"min_unique_users": 4}, {"min_pair_count": 2, "min_unique_users": 2}])
def test_pruning_by_support_changes_no_score(spark, thresholds):
    scorer = Scorer(**thresholds)
    sessions = build_sessions(clean(spark, random_events(3, users=20, items=25)), 180)
    whole, pruned = item_pairs(sessions), item_pairs(sessions, support=scorer.support())
    assert pruned.count() < whole.count()
    a, b = (scorer.score(aggregate_window(p, "2024-03-01", "2024-03-03")) for p in (whole, pruned))
    assert a.count()
    same_rows([tuple(r) for r in a.collect()], a.columns, [tuple(r) for r in b.collect()], b.columns)


def test_support_of_none(spark):
    sessions = build_sessions(clean(spark, random_events()), 180)
    assert not Scorer().support().prunes
    assert supported_items(session_items(sessions), Support(sessions=10_000)).count() == 0
