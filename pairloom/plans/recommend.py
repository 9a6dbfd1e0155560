"""From clean events to recommendations, and their evaluation: plans, and runs that write what they make."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import date, timedelta
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.config import Settings, get, override
from pairloom.operators.aggregate import aggregate_window, aggregate_window_from_daily
from pairloom.operators.cleaning import clean_events
from pairloom.operators.evaluation import OfflineMetrics, ground_truth, offline_metrics
from pairloom.operators.fallback import merge_fallback
from pairloom.operators.pairs import DailyPairStats, Support, daily_pair_stats, item_pairs
from pairloom.operators.popularity import action_distribution, action_shares, item_popularity
from pairloom.operators.sessions import HEAVY_EVENTS, build_sessions, build_sessions_of_all
from pairloom.output.writers import publish_latest, write_daily, write_detailed, write_enriched, write_lookup, write_manifest
from pairloom.plans.artifacts import KINDS, Catalogue, missing
from pairloom.plans.incremental import cached, daily_tables, day_inputs, input_identity
from pairloom.sources.files import joined, staged, staging


def window(train_until: str, lookback_days: int) -> tuple[str, str]:
    """First and last date of a lookback, both included."""
    if lookback_days <= 0:
        raise ValueError("lookback_days must be positive")
    end = date.fromisoformat(train_until)
    return str(end - timedelta(days=lookback_days - 1)), str(end)


@dataclass(frozen=True)
class Plan:
    """The tables of a run; without the first two where scoring starts from artifacts."""

    clean: DataFrame | None
    sessions: DataFrame | None
    popularity: DataFrame
    distribution: DataFrame
    aggregates: DataFrame
    scores: DataFrame
    recommendations: DataFrame


def _within(df: DataFrame, start: str, end: str, column: str = "event_date") -> DataFrame:
    return df.filter(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def recommend(clean: DataFrame, products: DataFrame | None, settings: Settings, train_until: str, daily: DailyPairStats | None = None, keep: str | None = None) -> Plan:
    """Recommendations from clean events of the lookback, or from daily pair tables built before.

    With ``keep`` the window's pair aggregates are written there and gone on from. Without it nobody sees them but the
    scorer, so items that cannot reach its thresholds make no pairs.
    """
    start, end = window(train_until, settings.lookback_days)
    clean = _within(clean, start, end)
    sessions = build_sessions_of_all(clean, settings.timeout_minutes)
    if daily is not None:
        aggregates = aggregate_window_from_daily(daily.counts, daily.user_keys, daily.session_keys, start, end, settings.time_decay)
    else:
        aggregates = aggregate_window(item_pairs(sessions, settings.pairs, Support() if keep else settings.scorer.support(), HEAVY_EVENTS), start, end, settings.time_decay)
    if keep is not None:
        aggregates.write.mode("overwrite").parquet(keep)
        aggregates = clean.sparkSession.read.parquet(keep)
    return score_and_rank(clean, sessions, item_popularity(clean, actions=settings.actions), action_distribution(clean, start, end, settings.actions), aggregates, products, settings)


def with_shares(settings: Settings, distribution: DataFrame) -> Settings:
    """The settings with the scorer's action shares, taken from the distribution where it needs and lacks them."""
    scorer = settings.scorer
    if scorer.method == "calibrated_multichannel" and scorer.action_shares is None and scorer.beta > 0:
        return replace(settings, scorer=replace(scorer, action_shares=action_shares(distribution)))
    return settings


def score_and_rank(clean: DataFrame | None, sessions: DataFrame | None, popularity: DataFrame, distribution: DataFrame, aggregates: DataFrame, products: DataFrame | None, settings: Settings) -> Plan:
    """The last steps alone, for runs that vary only them."""
    scores = with_shares(settings, distribution).scorer.score(aggregates, popularity)
    best = settings.topk.select(scores)
    if settings.fallback.enabled:
        best = merge_fallback(best, popularity, products, settings.fallback)
    return Plan(clean, sessions, popularity, distribution, aggregates, scores, best)


def validation_truth(clean: DataFrame, config: Mapping[str, Any], train_until: str, validation_days: int) -> DataFrame:
    """Ground truth of the days after training, from sessions of each day by itself and without any decay.

    Settings of the graph cannot move the target that they are tuned against.
    """
    first = date.fromisoformat(train_until) + timedelta(days=1)
    last = first + timedelta(days=validation_days - 1)
    off = {f"graph.{k}.enabled": False for k in ("distance_decay", "time_decay", "widget_context")}
    settings = Settings.from_config(override(config, off))
    days = _within(clean, str(first), str(last))
    # a user's days are apart, as users of their own
    apart = build_sessions(days.withColumn("user_id", F.struct("user_id", "event_date")), settings.timeout_minutes)
    return ground_truth(daily_pair_stats(apart, settings.pairs).counts, settings.relevance_mode, settings.relevance_weights)


@dataclass(frozen=True)
class RunResult:
    output_dir: str
    rows: int
    manifest: str
    metrics: OfflineMetrics | None = None


def _write_outputs(recommendations: DataFrame, products: DataFrame | None, out: str) -> DataFrame:
    """Detailed, look-up and enriched lists; the detailed ones as written."""
    write_detailed(recommendations, f"{out}/detailed.parquet")
    made = recommendations.sparkSession.read.parquet(f"{out}/detailed.parquet")
    write_lookup(made, f"{out}/lookup.parquet")
    if products is not None:
        write_enriched(made, products, f"{out}/enriched.parquet")
    return made


def _finish(out: str, run_id: str, train_until: str, period: tuple[str, str], rows: int, config: Mapping[str, Any], latest_dir: str | None, metrics: OfflineMetrics | None) -> RunResult:
    manifest = f"{out}/manifest.json"
    write_manifest(manifest, {"run_id": run_id, "train_until_date": train_until, "window_start": period[0], "window_end": period[1], "rows": rows, "lookup_path": "lookup.parquet", "detailed_path": "detailed.parquet"})
    if latest_dir is not None:
        publish_latest(out, latest_dir, rows, bool(get(config, "pipeline.allow_empty_latest_update", False)))
    return RunResult(out, rows, manifest, metrics)


def artifacts_folder(config: Mapping[str, Any], output_dir: str) -> str:
    return get(config, "artifacts.catalogue_dir", joined(output_dir, "_artifacts"))


def score(catalogue: str, products: DataFrame | None, config: Mapping[str, Any], train_until: str, output_dir: str, run_id: str, latest_dir: str | None = None) -> RunResult:
    """Scores, lists and outputs from what earlier runs have left in a catalogue; events aren't read and needn't exist.

    Settings of scoring, lists and fallback may differ from theirs, others must not.
    """
    settings, out = Settings.from_config(config), joined(output_dir, run_id)
    period, known = window(train_until, settings.lookback_days), Catalogue(catalogue)
    tables = known.tables(period, settings)
    if tables is None:
        raise FileNotFoundError(f"no {missing(known, period, settings)} in {catalogue}")
    with staging():
        plan = score_and_rank(None, None, tables["item_popularity"], tables["action_type_distribution"], tables["pair_aggregates"], products, settings)
        made = _write_outputs(plan.recommendations, products, out)
    return _finish(out, run_id, train_until, period, made.count(), config, latest_dir, None)


def run(raw: DataFrame, products: DataFrame | None, config: Mapping[str, Any], train_until: str, output_dir: str, run_id: str, validation_days: int = 0, latest_dir: str | None = None) -> RunResult:
    """A whole run: recommendations, look-up lists and side tables as Parquet, metrics if asked, and a manifest.

    Clean events are written once and read by all steps. With ``pipeline.update_strategy`` incremental, daily tables under
    ``pipeline.daily_dir`` (beside the runs, if there is none) are reused. The pairs of the window and the ground truth are
    kept too: the latter in the validation cache, by the files of its days and the settings that shape it. What scoring
    needs is noted in the catalogue of artifacts; with ``pipeline.reuse_artifacts`` it is taken from there, if it was made
    from the same files. Working tables are deleted at the end.
    """
    with staging():
        return _run(raw, products, config, train_until, output_dir, run_id, validation_days, latest_dir)


def _run(raw: DataFrame, products: DataFrame | None, config: Mapping[str, Any], train_until: str, output_dir: str, run_id: str, validation_days: int, latest_dir: str | None) -> RunResult:
    settings, spark = Settings.from_config(config), raw.sparkSession
    period, out = window(train_until, settings.lookback_days), joined(output_dir, run_id)
    known, inputs = Catalogue(artifacts_folder(config, output_dir)), input_identity(raw.inputFiles())
    last = str(date.fromisoformat(train_until) + timedelta(days=validation_days))
    tables = known.tables(period, settings, inputs) if inputs and get(config, "pipeline.reuse_artifacts", False) else None
    incremental = get(config, "pipeline.update_strategy") == "incremental"
    clean = None
    if tables is None or (validation_days and not incremental):
        clean = staged(_within(clean_events(raw, settings.actions), period[0], last))
    if tables is None:
        if not settings.allow_empty_input and _within(clean, *period).isEmpty():
            raise ValueError(f"no item events from {period[0]} to {period[1]}")
        daily = daily_tables(raw, settings, *period, get(config, "pipeline.daily_dir", joined(output_dir, "_daily"))) if incremental else None
        plan = recommend(clean, products, settings, train_until, daily, joined(out, "pair_aggregates.parquet"))
        plan.popularity.write.mode("overwrite").parquet(f"{out}/item_popularity.parquet")
        plan.distribution.write.mode("overwrite").parquet(f"{out}/action_type_distribution.parquet")
        tables = {kind: spark.read.parquet(f"{out}/{kind}.parquet") for kind in KINDS}
        for kind, df in tables.items():
            known.record(kind, period, settings, f"{out}/{kind}.parquet", df.count(), inputs)
    plan = score_and_rank(clean, None, tables["item_popularity"], tables["action_type_distribution"], tables["pair_aggregates"], products, settings)
    made = _write_outputs(plan.recommendations, products, out)
    rows, metrics = made.count(), None
    if validation_days:
        made_truth = lambda: validation_truth(clean if clean is not None else clean_events(raw, settings.actions), config, train_until, validation_days)
        if incremental:
            files = {d: files for d, files in day_inputs(raw).items() if train_until < d <= last}
            about = {"train_until": train_until, "validation_days": validation_days, "inputs": files, "actions": settings.actions, "timeout": settings.timeout_minutes, "priority": settings.pairs.signal_priority, "most_items": settings.pairs.max_items_per_session, "mode": settings.relevance_mode, "weights": settings.relevance_weights}
            truth = cached(get(config, "evaluation.cache_dir", joined(output_dir, "_validation_cache")), about, made_truth)
        else:
            truth = staged(made_truth())
        metrics = offline_metrics(made, truth, settings.topk.top_k, tables["item_popularity"], settings.ranking_actions, settings.min_ranking_relevance)
        write_manifest(f"{out}/metrics.json", metrics.as_dict())
    return _finish(out, run_id, train_until, period, rows, config, latest_dir, metrics)


def write_daily_stats(stats: DailyPairStats, folder: str) -> None:
    for name in ("counts", "widget_counts", "user_keys", "session_keys"):
        write_daily(getattr(stats, name), f"{folder}/{name}")
