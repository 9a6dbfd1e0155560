"""Many trials of the last steps in one pass over the pair aggregates.

Parameter sets are columns: each pair gets a score for each trial, is exploded to those whose thresholds it meets, and
lists are ranked by trial and item; tasks cut them before they are shuffled. Fallback and metrics go by trial too. So the
aggregates, popularity and truth are read as often for a hundred trials as for one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.config import Settings, override
from pairloom.operators.aggregate import with_weighted_counts
from pairloom.operators.evaluation import OfflineMetrics, metrics_of_trials
from pairloom.operators.fallback import merge_fallback
from pairloom.plans.recommend import with_shares
from pairloom.schemas import CONTRACTS, RAW_COUNTS, WEIGHTED_COUNTS
from pairloom.sources.files import staged


def _trial(number: int, settings: Settings) -> Column:
    """(trial, score, source) of a pair, null if it is not in the trial."""
    scorer, topk = settings.scorer, settings.topk
    score = scorer.base_score()
    if scorer.normalize_by_popularity:
        score = scorer.normalized(F.col(f"_item.{scorer.popularity_column}"), F.col(f"_similar.{scorer.popularity_column}"))
    inside = scorer.meets() & score.isNotNull()
    if scorer.min_score is not None:
        inside &= score >= scorer.min_score
    for c in ("pair_count", "unique_users", "unique_sessions"):
        if (least := getattr(topk, f"min_{c}")) is not None:
            inside &= F.col(c) >= least
    return F.when(inside, F.struct(F.lit(number).alias("trial"), score.cast("double").alias("score"), F.lit(topk.source).alias("source")))


def trial_lists(aggregates: DataFrame, popularity: DataFrame, trials: Sequence[Settings]) -> DataFrame:
    """Ranked recommendations with their counts, each trial's (column ``trial``, from 0) up to its own top_k."""
    df = with_weighted_counts(aggregates).filter("item_id IS NOT NULL AND similar_item_id IS NOT NULL AND item_id <> similar_item_id")
    columns = sorted({s.scorer.popularity_column for s in trials if s.scorer.normalize_by_popularity})
    if columns:
        of = popularity.select("item_id", F.struct(*[F.col(c).cast("double").alias(c) for c in columns]).alias("_item"))
        df = df.join(of, "item_id", "left").join(of.select(F.col("item_id").alias("similar_item_id"), F.col("_item").alias("_similar")), "similar_item_id", "left")
    counts = [*RAW_COUNTS, *WEIGHTED_COUNTS, "unique_users", "unique_sessions"]
    each = df.select("item_id", "similar_item_id", *counts, F.explode(F.array_compact(F.array(*[_trial(n, s) for n, s in enumerate(trials)]))).alias("_t")).select("item_id", "similar_item_id", *counts, "_t.*")
    best, ks = Window.partitionBy("trial", "item_id").orderBy(F.desc("score"), "similar_item_id"), [s.topk.top_k for s in trials]
    ranked = each.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= max(ks))
    return ranked.filter(F.col("rank") <= F.get(F.array(*map(F.lit, ks)), F.col("trial"))).select("trial", *CONTRACTS["recommendations"], *counts)


def with_fallback(lists: DataFrame, popularity: DataFrame, products: DataFrame | None, trials: Sequence[Settings]) -> DataFrame:
    """Lists filled by each trial's settings of fallback; trials that share them are filled together."""
    together: dict[Any, list[int]] = {}
    for n, s in enumerate(trials):
        together.setdefault(s.fallback if s.fallback.enabled else None, []).append(n)
    found: DataFrame | None = None
    for fallback, numbers in together.items():
        part = lists.filter(F.col("trial").isin(numbers))
        if fallback is not None:
            groups = lists.sparkSession.createDataFrame([(n,) for n in numbers], "trial int")
            part = merge_fallback(part, popularity, products, fallback, groups)
        found = part if found is None else found.unionByName(part)
    return found


def evaluate_trials(aggregates: DataFrame, popularity: DataFrame, distribution: DataFrame, products: DataFrame | None, truth: DataFrame, config: Mapping[str, Any], params: Sequence[Mapping[str, Any]]) -> list[OfflineMetrics]:
    """Metrics of parameter sets of scoring, lists and fallback, in their order."""
    trials = [with_shares(Settings.from_config(override(config, p)), distribution) for p in params]
    lists = staged(trial_lists(aggregates, popularity, trials))
    made = staged(with_fallback(lists, popularity, products, trials))
    return metrics_of_trials(made, truth, [s.topk.top_k for s in trials], popularity, trials[0].ranking_actions, trials[0].min_ranking_relevance)
