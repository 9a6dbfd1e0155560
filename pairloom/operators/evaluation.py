"""Offline evaluation: temporal split, ground truth, ranking metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, fields
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.aggregate import with_weighted_counts
from pairloom.operators.fallback import LEVELS
from pairloom.schemas import ACTIONS

# What an action says of relevance.
RELEVANCE_WEIGHTS = {"view": 0.1, "click": 0.3, "favorite": 0.6, "to_cart": 1.0}
RANKING_ACTIONS = ("click", "favorite", "to_cart")
MIN_RANKING_RELEVANCE = 0.3


@dataclass(frozen=True)
class TemporalSplit:
    train_until: str
    validation_start: str
    validation_end: str

    def __post_init__(self) -> None:
        if not date.fromisoformat(self.train_until) < date.fromisoformat(self.validation_start) <= date.fromisoformat(self.validation_end):
            raise ValueError("training must end before validation starts, which must not be after its end")


def split_train_validation(df: DataFrame, split: TemporalSplit, date_column: str = "event_date") -> tuple[DataFrame, DataFrame]:
    """Rows up to the training date, and rows of the validation window; rows with unreadable dates are in neither."""
    day = F.col(date_column).try_cast("date")
    d = lambda s: F.lit(s).cast("date")
    return df.filter(day <= d(split.train_until)), df.filter(day.between(d(split.validation_start), d(split.validation_end)))


def ground_truth(counts: DataFrame, mode: str = "binary", weights: Mapping[str, float] | None = None, min_relevance: float = 0.0) -> DataFrame:
    """Relevant pairs of daily counts: relevance 1, or the weighted sum of the actions' counts."""
    if mode not in ("binary", "graded"):
        raise ValueError("the relevance mode must be binary or graded")
    weights = weights or RELEVANCE_WEIGHTS
    by = with_weighted_counts(counts).groupBy("item_id", F.col("similar_item_id").alias("relevant_item_id")).agg(F.sum("pair_count").alias("evidence_count"), *(F.sum(f"{a}_count").alias(f"{a}_count") for a in ACTIONS))
    relevance: Column = F.lit(1.0)
    if mode == "graded":
        relevance = F.lit(0.0)
        for a in ACTIONS:
            relevance = relevance + F.lit(float(weights.get(a, 0.0))) * F.col(f"{a}_count")
    strongest = F.lit("view")
    for a in ACTIONS:  # the last that counts is the strongest
        strongest = F.when(F.col(f"{a}_count") > 0, F.lit(a)).otherwise(strongest)
    found = by.withColumn("relevance", relevance).filter(F.col("relevance") > min_relevance).withColumn("target_action_type", strongest)
    return found.select("item_id", "relevant_item_id", "relevance", "target_action_type", "evidence_count", *(f"{a}_count" for a in ACTIONS))


def ranking_truth(truth: DataFrame, actions: Sequence[str] | None = None, min_relevance: float | None = MIN_RANKING_RELEVANCE) -> DataFrame:
    """Truth of relevant actions, or of any but views with enough relevance."""
    if min_relevance is not None and min_relevance < 0:
        raise ValueError("min_relevance must not be negative")
    actions = RANKING_ACTIONS if actions is None else actions
    named = F.col("target_action_type").isin(*actions) if actions else F.lit(False)
    enough = (F.col("target_action_type") != "view") & (F.col("relevance") >= min_relevance) if min_relevance is not None else F.lit(False)
    return truth.filter(named | enough)


def item_metrics(recommendations: DataFrame, truth: DataFrame, top_k: int | Column, by: Sequence[str] = ()) -> DataFrame:
    """One row for each item with truth: hits, recall, reciprocal rank, nDCG, and hits by action.

    With ``by`` both tables have these columns, as trials that are evaluated together, and each value is apart; ``top_k`` may
    be a column of both then.
    """
    item = [*by, "item_id"]
    shown = recommendations.filter(F.col("rank") <= top_k).groupBy(*item, F.col("similar_item_id").alias("relevant_item_id")).agg(F.min("rank").alias("rank"))
    totals = truth.groupBy(*item).agg(F.sum("relevance").alias("total"), *(F.count_if(F.col(f"{a}_count") > 0).alias(f"{a}_total") for a in ACTIONS))
    hits = truth.join(shown, [*item, "relevant_item_id"]).groupBy(*item).agg(
        F.count("*").alias("hits"), F.sum("relevance").alias("found"), F.min("rank").alias("first"), F.sum(F.col("relevance") / F.log2(F.col("rank") + 1)).alias("dcg"), *(F.count_if(F.col(f"{a}_count") > 0).alias(f"{a}_hits") for a in ACTIONS)
    )
    best = Window.partitionBy(*item).orderBy(F.desc("relevance"), "relevant_item_id")
    ideal = truth.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= top_k).groupBy(*item).agg(F.sum(F.col("relevance") / F.log2(F.col("place") + 1)).alias("ideal"))
    joined = totals.join(hits, item, "left").join(ideal, item, "left")
    by_action = [x for a in ACTIONS for x in (
        F.when(F.col(f"{a}_total") > 0, (F.coalesce(f"{a}_hits", F.lit(0)) > 0).cast("double")).alias(f"{a}_hit"),
        F.when(F.col(f"{a}_total") > 0, F.coalesce(f"{a}_hits", F.lit(0)) / F.col(f"{a}_total")).alias(f"{a}_recall"),
    )]
    return joined.select(
        *item, (F.coalesce("hits", F.lit(0)) > 0).cast("double").alias("hit"), F.coalesce(F.try_divide("found", "total"), F.lit(0.0)).alias("recall"),
        F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias("mrr"), F.coalesce(F.try_divide("dcg", "ideal"), F.lit(0.0)).alias("ndcg"), *by_action,
    )


def mean_metrics(recommendations: DataFrame, truth: DataFrame, top_k: int | Column, by: Sequence[str] = ()) -> DataFrame:
    """One row, or one for each ``by``: the means over the items with truth, null where there are none."""
    per_item = item_metrics(recommendations, truth, top_k, by)
    return per_item.groupBy(*by).agg(*(F.avg(c).alias(c) for c in per_item.columns if c not in (*by, "item_id")), F.count("*").alias("items"))


def source_shares(recommendations: DataFrame, top_k: int | Column, by: Sequence[str] = ()) -> DataFrame:
    """One row: the share of shown rows that are fallback, in all and by level; a missing source counts as fallback."""
    shown = recommendations.filter(F.col("rank") <= top_k)
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    return shown.groupBy(*by).agg(share(F.col("source").isNull() | (F.col("source") != "behavioral")).alias("fallback_share"), *(share(F.col("source") == label).alias(f"fallback_{level}_share") for level, label in LEVELS.items()))


def popularity_bias(recommendations: DataFrame, popularity: DataFrame, top_k: int | Column, column: str = "unique_users", by: Sequence[str] = ()) -> DataFrame:
    """One row: mean popularity of shown items against the largest; null without data."""
    of = popularity.select(F.col("item_id").alias("similar_item_id"), F.col(column).cast("double").alias("_p"))
    shown = recommendations.filter(F.col("rank") <= top_k).join(of, "similar_item_id").groupBy(*by).agg(F.avg("_p").alias("_mean"))
    most = of.agg(F.max("_p").alias("_max"))
    return shown.join(F.broadcast(most)).select(*by, F.when(F.col("_max") > 0, F.col("_mean") / F.col("_max")).alias("popularity_bias"))  # the largest is one row


def coverage(recommendations: DataFrame, truth: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row: the share of items with truth that have recommendations, how many items that is, and how many have truth."""
    item = [*by, "item_id"]
    known = recommendations.select(*item).distinct().withColumn("_has", F.lit(1.0))
    return truth.select(*item).distinct().join(known, item, "left").groupBy(*by).agg(F.avg(F.coalesce("_has", F.lit(0.0))).alias("coverage"), F.count("_has").alias("covered"), F.count("*").alias("items"))


def fallback_hits(recommendations: DataFrame, truth: DataFrame, top_k: int | Column, by: Sequence[str] = ()) -> DataFrame:
    """One row: hit rate and recall that fallback rows alone give."""
    rows = recommendations.filter(F.col("source").isNull() | (F.col("source") != "behavioral"))
    return mean_metrics(rows, truth, top_k, by).select(*by, F.col("hit").alias("fallback_hit_rate"), F.col("recall").alias("fallback_recall"))


# Names of metrics, which readers of results go by.
@dataclass(frozen=True)
class OfflineMetrics:
    hit_rate_at_k: float | None = None
    recall_at_k: float | None = None
    ndcg_at_k: float | None = None
    mrr_at_k: float | None = None
    strong_hit_rate_at_k: float | None = None
    strong_recall_at_k: float | None = None
    strong_mrr_at_k: float | None = None
    strong_ndcg_at_k: float | None = None
    to_cart_mrr_at_k: float | None = None
    to_cart_ndcg_at_k: float | None = None
    coverage_at_k: float | None = None
    popularity_bias_at_k: float | None = None
    fallback_share_at_k: float | None = None
    fallback_category_type_share_at_k: float | None = None
    fallback_category_share_at_k: float | None = None
    fallback_type_share_at_k: float | None = None
    fallback_brand_share_at_k: float | None = None
    fallback_global_share_at_k: float | None = None
    fallback_hit_rate_at_k: float | None = None
    fallback_recall_at_k: float | None = None
    fallback_to_cart_hit_rate_at_k: float | None = None
    fallback_to_cart_recall_at_k: float | None = None
    view_hit_rate_at_k: float | None = None
    view_recall_at_k: float | None = None
    click_hit_rate_at_k: float | None = None
    click_recall_at_k: float | None = None
    favorite_hit_rate_at_k: float | None = None
    favorite_recall_at_k: float | None = None
    to_cart_hit_rate_at_k: float | None = None
    to_cart_recall_at_k: float | None = None
    evaluated_items: int = 0
    recommended_items: int = 0
    ground_truth_pairs: int = 0
    all_evaluated_items: int = 0
    ranking_evaluated_items: int = 0
    view_only_ground_truth_pairs: int = 0
    ranking_ground_truth_pairs: int = 0

    def as_dict(self) -> dict[str, Any]:
        return asdict(self)


def offline_metrics(recommendations: DataFrame, truth: DataFrame, top_k: int, popularity: DataFrame | None = None, ranking_actions: Sequence[str] | None = None, min_ranking_relevance: float | None = MIN_RANKING_RELEVANCE) -> OfflineMetrics:
    """All metrics on three slices of the truth: for ranking, all of it, and to_cart. Single rows reach the driver."""
    return metrics_of_trials(recommendations.withColumn("trial", F.lit(0)), truth, [top_k], popularity, ranking_actions, min_ranking_relevance)[0]


def metrics_of_trials(recommendations: DataFrame, truth: DataFrame, top_k: Sequence[int], popularity: DataFrame | None = None, ranking_actions: Sequence[str] | None = None, min_ranking_relevance: float | None = MIN_RANKING_RELEVANCE) -> list[OfflineMetrics]:
    """The metrics of several trials in one pass: recommendations have a column ``trial``, from 0, and each trial its top_k.

    Truth meets the trials, which are a row each; for each group of metrics, a row for each trial reaches the driver.
    """
    if min(top_k) <= 0:
        raise ValueError("top_k must be positive")
    ks = F.array(*[F.lit(int(k)) for k in top_k])
    trials = truth.sparkSession.createDataFrame(list(enumerate(map(int, top_k))), "trial int, k int")
    recommendations = recommendations.withColumn("k", F.get(ks, F.col("trial")))
    if len(top_k) == 1:
        truth = truth.withColumns({"trial": F.lit(0), "k": F.lit(int(top_k[0]))})
    else:
        truth = truth.join(F.broadcast(trials))
    k, by = F.col("k"), ["trial"]
    strong = ranking_truth(truth, ranking_actions, min_ranking_relevance)
    carts = truth.filter("to_cart_count > 0")

    def rows(df: DataFrame) -> list[dict[str, Any]]:
        """Values of each trial; of one without rows, none."""
        found = {r["trial"]: r.asDict() for r in df.collect()}
        none = dict.fromkeys(df.columns)
        return [found.get(t, none) for t in range(len(top_k))]

    means = [rows(mean_metrics(recommendations, t, k, by)) for t in (strong, truth, carts)]
    parts = [rows(source_shares(recommendations, k, by)), rows(coverage(recommendations.filter(F.col("rank") <= k), strong, by))]
    late = [rows(fallback_hits(recommendations, t, k, by)) for t in (strong, carts)]
    counts = rows(truth.groupBy("trial").agg(F.count("*").alias("pairs"), F.count_if(F.expr("view_count > 0 AND click_count <= 0 AND favorite_count <= 0 AND to_cart_count <= 0")).alias("view_only")))
    strong_counts = rows(strong.groupBy("trial").agg(F.count("*").alias("pairs")))
    bias = rows(popularity_bias(recommendations, popularity, k, by=by)) if popularity is not None else [{"popularity_bias": None}] * len(top_k)
    return [_metrics(*each) for each in zip(*means, *parts, *late, counts, strong_counts, bias, strict=True)]


def _metrics(*rows: dict[str, Any]) -> OfflineMetrics:
    """From the rows of a trial: means over three slices, shares, coverage, fallback's hits on two, counts, popularity bias."""
    ranking, full, cart, shares, covered, fallback, fallback_cart, counts, strong_counts, bias = ({c: v for c, v in r.items() if c != "trial"} for r in rows)
    values: dict[str, Any] = {f"{p}{n}_at_k": ranking[c] for p in ("", "strong_") for n, c in (("hit_rate", "hit"), ("recall", "recall"), ("mrr", "mrr"), ("ndcg", "ndcg"))}
    values |= {"to_cart_mrr_at_k": cart["mrr"], "to_cart_ndcg_at_k": cart["ndcg"], "coverage_at_k": covered["coverage"]}
    values |= {f"{k}_at_k": v for k, v in shares.items()} | {f"{k}_at_k": v for k, v in fallback.items()} | {f"{k.replace('fallback_', 'fallback_to_cart_')}_at_k": v for k, v in fallback_cart.items()}
    values |= {f"{a}_{n}_at_k": full[f"{a}_{c}"] for a in ACTIONS for n, c in (("hit_rate", "hit"), ("recall", "recall"))}
    values["popularity_bias_at_k"] = bias["popularity_bias"]
    number = {"evaluated_items": ranking["items"], "ranking_evaluated_items": ranking["items"], "all_evaluated_items": full["items"], "ground_truth_pairs": counts["pairs"], "view_only_ground_truth_pairs": counts["view_only"], "recommended_items": covered["covered"], "ranking_ground_truth_pairs": strong_counts["pairs"]}
    values |= {name: n or 0 for name, n in number.items()}
    return OfflineMetrics(**{f.name: values[f.name] for f in fields(OfflineMetrics) if f.name in values})


@dataclass(frozen=True)
class Scorecard:
    experiment_id: str
    train_until_date: str
    lookback_days: int
    top_k: int
    metrics: Mapping[str, Any]
    notes: str | None = None
    metadata: Mapping[str, Any] | None = None

    def __post_init__(self) -> None:
        if not self.experiment_id.strip() or self.lookback_days <= 0 or self.top_k <= 0:
            raise ValueError("an id and positive lookback_days and top_k are needed")
        date.fromisoformat(self.train_until_date)
