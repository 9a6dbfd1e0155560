import datetime as dt
import io
import json
import os
import random
import tarfile

import pytest
from helpers import clean, ts

from pairloom.config import Settings, load, override
from pairloom.output.writers import lookup_lists, publish_latest, write_daily, write_preview
from pairloom.plans import incremental, tuning
from pairloom.plans.recommend import recommend, run, validation_truth, window
from pairloom.schemas import empty, require_columns
from pairloom.serving.lookup import SimilarItems
from pairloom.sources.events import event_dates, extract_archive, file_rows, filter_dates, load_events, newest_results, payload_dir, scan_events, scan_or_empty, scan_products

PROD = "item_id long, name string, brand string, type string, category_id long, category_name string"
CONFIG = {"pipeline": {"session_timeout_minutes": 30, "lookback_days": 2, "top_k": 3}, "scoring": {"method": "calibrated_multichannel"}, "business": {"fallback": {"enabled": True, "top_k": 3}}, "evaluation": {"relevance_mode": "graded"}}
EVENTS = [(u, ts(day, f"10:{k:02d}"), a, i) for u in (1, 2) for day in (1, 2, 3) for k, (i, a) in enumerate([(1, "view"), (10, "to_cart"), (3 + u, "click")])]


def raw(spark, rows=EVENTS):
    df = clean(spark, rows)
    return df.withColumnRenamed("event_date", "date")


def products(spark):
    return spark.createDataFrame([(i, f"item {i}", "b", "t", 1, "c") for i in (1, 4, 5, 10, 11)], PROD)


def test_a_run_from_files_to_serving(spark, tmp_path):
    raw(spark).write.partitionBy("date", "action_type").parquet(f"{tmp_path}/events")
    products(spark).write.parquet(f"{tmp_path}/products/day=1")
    events = scan_events(spark, f"{tmp_path}/events")
    result = run(events, scan_products(spark, f"{tmp_path}/products"), CONFIG, "2024-03-02", f"{tmp_path}/runs", "r1", 1, f"{tmp_path}/latest")
    assert 10 in SimilarItems(spark, f"{tmp_path}/latest/manifest.json").get(1)
    assert SimilarItems(spark, result.output_dir).get(1, 1) == [10]
    assert SimilarItems(spark, f"{result.output_dir}/lookup.parquet").get(77) == []
    assert result.metrics.hit_rate_at_k == 1.0
    assert json.loads(open(result.manifest).read())["window_start"] == "2024-03-01"
    with pytest.raises(ValueError, match="top_k"):
        SimilarItems(spark, result.output_dir).get(1, 0)
    with pytest.raises(ValueError, match="no item events"):
        run(events, None, CONFIG, "2023-01-01", f"{tmp_path}/runs", "r2")


def test_sources(spark, tmp_path):
    root = f"{tmp_path}/events"
    raw(spark).write.partitionBy("date", "action_type").parquet(root)
    df = scan_events(spark, root)
    assert event_dates(df) == ["2024-03-01", "2024-03-02", "2024-03-03"]
    assert load_events(spark, root).select("date").distinct().count() == 1
    assert load_events(spark, root, start="2024-03-02").select("date").distinct().count() == 2
    assert load_events(spark, root, sample_rows=2).count() == 2
    pruned = scan_events(spark, root, dates=["2024-03-01"], actions=["view"], columns=["item_id"])
    assert pruned.count() == 2
    assert "PartitionFilters" in pruned._jdf.queryExecution().toString()
    with pytest.raises(FileNotFoundError):
        scan_events(spark, root, dates=["1999-01-01"])
    assert filter_dates(["b", "a", "c"], sample_days=2) == ["a", "b"]
    assert filter_dates([], ["z", "a", "a"], start="b") == ["z"]
    assert sum(r["rows"] for r in file_rows(spark, root).collect()) == len(EVENTS)
    assert scan_or_empty(spark, [f"{tmp_path}/none"], "ground_truth").count() == 0
    assert payload_dir(tmp_path, ["x", "events"]).name == "events"
    assert payload_dir(f"file://{tmp_path}", ["x", "events"]) == f"file://{tmp_path}/events"
    with pytest.raises(FileNotFoundError):
        payload_dir(f"file://{tmp_path}/none", ["x"])


def test_newest_results(spark, tmp_path):
    for k, name in enumerate(("b", "a", "c")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "results.csv").write_text(f"trial_id,hit\n{name},0.{k}\n")
        os.utime(tmp_path / name / "results.csv", (1000 + k % 2, 1000 + k % 2))
    assert newest_results(spark, str(tmp_path)).first().asDict() == {"trial_id": "a", "hit": 0.1}
    with pytest.raises(FileNotFoundError):
        newest_results(spark, f"{tmp_path}/a/x")


def test_archive(tmp_path):
    def packed(name, member):
        with tarfile.open(tmp_path / name, "w:gz") as tar:
            info = tarfile.TarInfo(member)
            info.size = 1
            tar.addfile(info, io.BytesIO(b"x"))
        return tmp_path / name

    target = extract_archive(packed("a.tar.gz", "d/part.parquet"), tmp_path / "out")
    assert (target / "d/part.parquet").exists()
    (target / "d/part.parquet").unlink()
    extract_archive(tmp_path / "a.tar.gz", tmp_path / "out")
    assert not (target / "d/part.parquet").exists()  # not unpacked again
    extract_archive(tmp_path / "a.tar.gz", tmp_path / "out", force=True)
    assert (target / "d/part.parquet").exists()
    with pytest.raises(tarfile.TarError):
        extract_archive(packed("b.tar.gz", "../evil"), tmp_path / "other")
    assert not (tmp_path / "other").exists()


def test_outputs(spark, tmp_path):
    recs = spark.createDataFrame([(1, 9, 1.0, 3, "b"), (1, 8, 1.0, 1, "b"), (1, 7, 1.0, 1, "b"), (1, None, 1.0, 2, "b")], "item_id long, similar_item_id long, score double, rank long, source string")
    assert lookup_lists(recs).first()["similar_items_sku_list"] == [7, 8, 9]
    day = lambda d, n: spark.createDataFrame([(dt.date(2024, 3, d), n)], "pair_date date, n long")
    for d, n in ((1, 1), (2, 2), (1, 3)):
        write_daily(day(d, n), f"{tmp_path}/daily")
    assert sorted(r["n"] for r in spark.read.parquet(f"{tmp_path}/daily").collect()) == [2, 3]
    write_preview(recs, f"{tmp_path}/preview")
    assert spark.read.csv(f"{tmp_path}/preview/preview_csv", header=True).count() == 4
    assert not publish_latest(f"{tmp_path}/daily", f"{tmp_path}/latest", 0)
    with pytest.raises(ValueError, match="missing expected columns"):
        require_columns(recs.drop("rank"), "recommendations")
    assert empty(spark, "widget_output").count() == 0


def test_validation_ignores_decay_and_midnight(spark):
    rows = [(1, ts(3, "23:55"), "view", 1), (1, ts(3, "23:58"), "click", 2), (1, ts(4, "00:05"), "view", 3)]
    tuned = override(CONFIG, {"graph.distance_decay.enabled": True, "graph.distance_decay.max_distance": 1})
    truth = validation_truth(clean(spark, rows), tuned, "2024-03-02", 2)
    assert {(r["item_id"], r["relevant_item_id"]) for r in truth.collect()} == {(1, 2), (2, 1)}


def test_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps(CONFIG))
    s = Settings.from_config(load(tmp_path / "c.json"))
    assert (s.topk.top_k, s.fallback.enabled, s.timeout_minutes) == (3, True, 30)
    assert Settings.from_config({"fallback": {"top_k": 4}, "business": {"fallback": {"top_k": 5}}}).fallback.top_k == 5
    assert window("2024-03-02", 2) == ("2024-03-01", "2024-03-02")
    with pytest.raises(ValueError):
        Settings.from_config({"pipeline": {"update_strategy": "x"}})


def test_incremental(tmp_path):
    f = tmp_path / "day.parquet"
    f.write_text("x")
    keys = {d: {"in": incremental.input_identity([f]), "window_start": "a", "day": d} for d in ("2024-03-01", "2024-03-02", "2024-03-03")}
    for d, k in keys.items():
        incremental.record(tmp_path, "pairs", d, k, [f])
    assert incremental.stale_days(tmp_path, "pairs", keys) == []
    changed = {**keys, "2024-03-02": {**keys["2024-03-02"], "window_start": "b"}}
    assert incremental.stale_days(tmp_path, "pairs", changed) == ["2024-03-02", "2024-03-03"]
    f.write_text("longer")
    assert incremental.input_identity([f]) != keys["2024-03-01"]["in"]
    os.unlink(f)
    assert len(incremental.stale_days(tmp_path, "pairs", keys)) == 3
    with pytest.raises(ValueError, match="session state"):
        incremental.state_date_matches("2024-03-04", "2024-03-03")
    assert len(incremental.cache_key({"a": 1})) == 24


def test_incremental_runs_equal_full_ones(spark, tmp_path):
    """Also after a day is replaced, one is added, and the window moves; days that didn't change aren't written again."""
    rnd = random.Random(5)

    def write(day, n):
        rows = [(u, ts(day, f"{h:02}:{m:02}"), rnd.choice(["view", "click", "to_cart"]), rnd.randrange(8)) for u in range(6) for h, m in [(rnd.randrange(24), rnd.randrange(60)) for _ in range(n)]]
        rows += [(7, ts(day, f"{h:02}:00"), "view", h % 8) for h in range(0, 24)]  # one session over all days
        raw(spark, rows).write.mode("overwrite").partitionBy("date", "action_type").option("partitionOverwriteMode", "dynamic").parquet(f"{tmp_path}/events")

    def both(until, name, days):
        config = override(CONFIG, {"pipeline.session_timeout_minutes": 70, "pipeline.lookback_days": days, "pipeline.daily_dir": f"{tmp_path}/daily"})
        events = scan_events(spark, f"{tmp_path}/events")
        found = []
        for strategy in ("full_retrain", "incremental"):
            result = run(events, products(spark), override(config, {"pipeline.update_strategy": strategy}), until, f"{tmp_path}/out-{strategy}", name, validation_days=int(name == "a"))
            table = spark.read.parquet(f"{result.output_dir}/detailed.parquet")
            found.append((sorted(map(tuple, table.select("item_id", "similar_item_id", "score", "rank", "source", "pair_count", "unique_users", "unique_sessions").collect())), result.metrics))
        assert found[0] == found[1]
        assert found[0][0]

    for day in (1, 2, 3, 4):
        write(day, 5)
    both("2024-03-03", "a", 3)
    stamp = lambda: {p.name: p.stat().st_mtime_ns for p in (tmp_path / "daily/counts").iterdir() if p.is_dir()}
    before = stamp()
    both("2024-03-03", "b", 3)
    assert stamp() == before  # all from before
    write(2, 3)
    both("2024-03-03", "c", 3)
    write(5, 4)
    both("2024-03-04", "d", 3)


def test_validation_cache_and_latest(spark, tmp_path):
    made = []

    def truth():
        made.append(1)
        return spark.createDataFrame([(len(made),)], "n long")

    for about, n in (({"a": 1}, 1), ({"a": 1}, 1), ({"a": 2}, 2)):
        assert incremental.cached(f"{tmp_path}/cache", about, truth).first()["n"] == n
    spark.createDataFrame([(1, [5])], "item_id long, similar_items_sku_list array<long>").write.parquet(f"{tmp_path}/r1/lookup.parquet")
    assert publish_latest(f"{tmp_path}/r1", f"{tmp_path}/latest", 1)
    assert SimilarItems(spark, f"{tmp_path}/latest").get(1) == [5]
    assert not publish_latest(f"{tmp_path}/r2", f"{tmp_path}/latest", 0)
    assert publish_latest(f"{tmp_path}/r2", f"{tmp_path}/latest", 0, allow_empty=True)


def test_values_of_parameters():
    assert tuning.values({"type": "float_range", "min": 0.1, "max": 0.5, "step": 0.1}) == [0.1, 0.2, 0.3, 0.4, 0.5]
    assert tuning.values({"type": "log_float_range", "min": 0.1, "max": 10.0}) == [0.1, 1.0, 10.0]
    assert tuning.values({"type": "log_float_range", "min": 1.0, "max": 16.0, "num": 5}) == [1.0, 2.0, 4.0, 8.0, 16.0]
    assert tuning.values({"values": [3]}) == [3]
    rng = random.Random(1)
    drawn = {tuning.draw({"type": "float_range", "min": 0.0, "max": 1.0}, rng) for _ in range(50)}
    assert len(drawn) == 50 and min(drawn) > 0 and max(drawn) < 1
    for wrong in ({"type": "float_range", "min": 0.0, "max": 1.0}, {"type": "choice", "values": []}, {"type": "int_range", "min": 2, "max": 1}, {"type": "log_float_range", "min": 0.0, "max": 1.0}, {"type": "list"}):
        with pytest.raises(ValueError):
            tuning.values(wrong)


def test_constraints():
    spec = {"primary": "hit", "constraints": {"minimum_cov": 0.9}}
    with pytest.raises(ValueError, match="min_ or max_"):
        tuning.objective({"hit": 0.5, "cov": 0.1}, spec)
    assert tuning.objective({"hit": 0.5}, {"primary": "hit", "constraints": {"max_bias": 0.1}}) == pytest.approx(0.25)  # a missing metric is 0
    assert tuning.objective({"hit": 0.5}, {"primary": "hit", "constraints": {"min_cov": 0.1}}) is None


SPACE = {"scoring.beta": {"type": "float_range", "min": 0.0, "max": 1.0, "step": 0.5}, "topk.top_k": {"type": "choice", "values": [1, 2]}}
SPEC = {"primary": "hit", "supporting": ["recall"], "penalties": ["bias"], "constraints": {"min_hit": 0.1}}


def test_tuning(tmp_path):
    assert len(list(tuning.grid(SPACE))) == 6
    assert len({json.dumps(p) for p in tuning.sampled(SPACE, 6, seed=1)}) == 6
    assert tuning.objective({"hit": 0.05}, SPEC) is None
    assert tuning.objective({"hit": 0.5, "recall": 0.5, "bias": 0.5}, SPEC) == pytest.approx(0.25)
    assert tuning.objective({"hit": 0.5, "recall": 0.0, "bias": 0.5}, SPEC) == 0.0
    evaluate = lambda p: {"hit": p["scoring.beta"] + 0.2, "recall": 1.0, "bias": 0.0}
    sweep = tuning.Sweep(evaluate, SPEC, str(tmp_path / "grid"))
    assert sweep.run(tuning.grid(SPACE))["params"]["scoring.beta"] == 1.0
    assert (tmp_path / "grid/results.csv").exists()
    again = tuning.recover(str(tmp_path / "grid"), SPEC)
    assert len(again.results) == 6
    assert tuning.best(again.results, SPEC)["params"]["scoring.beta"] == 1.0
    assert len(tuning.Sweep(evaluate, SPEC, str(tmp_path / "h")).halving(list(tuning.grid(SPACE)), evaluate)) > 0
    assert tuning.Sweep(evaluate, SPEC, str(tmp_path / "s")).annealing(SPACE, 8, seed=3)["objective"] > 0
    assert tuning.is_scoring_only(SPACE)
    assert not tuning.is_scoring_only({"graph.x": {}})


def test_scoring_trials(spark):
    plan = recommend(clean(spark, EVENTS), products(spark), Settings.from_config(CONFIG), "2024-03-02")
    truth = validation_truth(clean(spark, EVENTS), CONFIG, "2024-03-02", 1)
    evaluate = tuning.scoring_trials(plan.clean, plan.sessions, plan.popularity, plan.distribution, plan.aggregates, products(spark), truth, CONFIG)
    assert evaluate({"topk.top_k": 2, "scoring.beta": 0.0})["hit_rate_at_k"] == 1.0
    with pytest.raises(ValueError, match="only"):
        evaluate({"pipeline.lookback_days": 3})


def test_streamed_sessions(spark, tmp_path):
    from pairloom.streaming.sessions import session_windows

    late = [(9, ts(9, "10:00"), "view", 1)]  # moves the watermark on
    rows = [(1, ts(1, "10:00"), "view", 1), (1, ts(1, "10:30"), "click", 2), (1, ts(1, "11:01"), "view", 3)]
    df = clean(spark, rows + late)
    df.write.parquet(f"{tmp_path}/in")
    stream = session_windows(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), 30)
    q = stream.writeStream.format("memory").queryName("found").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((r["user_id"], r["events"], sorted(r["items"])) for r in spark.table("found").collect())
    assert got == [(1, 1, [3]), (1, 2, [1, 2])]
