"""Settings from a mapping, as a YAML or JSON file has them."""

from __future__ import annotations

import copy
import json
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from pairloom.functions.decay import DISTANCE_WEIGHTS, TIME_WEIGHTS, DistanceDecay, TimeDecay, WidgetContext
from pairloom.operators.fallback import FallbackSettings
from pairloom.operators.pairs import PairSettings
from pairloom.operators.scoring import BUSINESS_WEIGHTS, MAX_FREQUENCY_BOOST, Scorer
from pairloom.operators.topk import TopK
from pairloom.schemas import ACTIONS


def load(path: str | Path) -> dict[str, Any]:
    """JSON, or YAML where a parser is installed."""
    text = Path(path).read_text()
    if Path(path).suffix in (".yaml", ".yml"):
        import yaml

        value = yaml.safe_load(text)
    else:
        value = json.loads(text)
    if not isinstance(value, dict):
        raise ValueError(f"{path} has no mapping")
    return value


def get(config: Mapping[str, Any], path: str, default: Any = None) -> Any:
    """A value by its dotted path; null counts as missing."""
    value: Any = config
    for part in path.split("."):
        value = value.get(part) if isinstance(value, Mapping) else None
    return default if value is None else value


def override(config: Mapping[str, Any], changes: Mapping[str, Any]) -> dict[str, Any]:
    """A copy with values set by dotted paths."""
    out = copy.deepcopy(dict(config))
    for path, value in changes.items():
        *above, last = path.split(".")
        at = out
        for part in above:
            at = at.setdefault(part, {})
        at[last] = value
    return out


def _table(given: Mapping[Any, Any] | None, default: Mapping[int | str, float]) -> dict[int | str, float]:
    return {k if k == "default" else int(k): float(v) for k, v in (given or default).items()}


@dataclass(frozen=True)
class Settings:
    """All that a run needs; keys for manual buckets and batches are accepted and left to Spark's shuffles."""

    timeout_minutes: float
    lookback_days: int
    actions: tuple[str, ...]
    pairs: PairSettings
    time_decay: TimeDecay
    scorer: Scorer
    topk: TopK
    fallback: FallbackSettings
    relevance_mode: str
    relevance_weights: Mapping[str, float] | None
    ranking_actions: tuple[str, ...] | None
    min_ranking_relevance: float | None
    allow_empty_input: bool

    @classmethod
    def from_config(cls, c: Mapping[str, Any]) -> Settings:
        if get(c, "pipeline.update_strategy", "full_retrain") not in ("full_retrain", "incremental"):
            raise ValueError("unknown update_strategy")
        actions = tuple(get(c, "events.item_action_types", ACTIONS))
        top_k = int(get(c, "topk.top_k", get(c, "pipeline.top_k", 20)))
        distance, time, widget = (get(c, f"graph.{k}", {}) for k in ("distance_decay", "time_decay", "widget_context"))
        if "blocked_widgets" in widget:
            raise ValueError("blocked_widgets is not supported; give such widgets a weight")
        ranking = get(c, "evaluation.ranking_relevant_action_types")
        return cls(
            timeout_minutes=float(get(c, "pipeline.session_timeout_minutes", 30)),
            lookback_days=int(get(c, "pipeline.lookback_days", 30)),
            actions=actions,
            pairs=PairSettings(
                max_items_per_session=int(get(c, "pipeline.max_items_per_session", 50)),
                actions=actions,
                signal_priority=get(c, "item_pair_builder.signal_priority"),
                distance_decay=DistanceDecay(bool(distance.get("enabled", False)), distance.get("strategy") or "none", distance.get("max_distance"), _table(distance.get("weight_by_distance"), DISTANCE_WEIGHTS), float(get(distance, "exponential.alpha", 0.5)), float(get(distance, "exponential.min_weight", 0.05))),
                widget_context=WidgetContext(bool(widget.get("enabled", False)), dict(widget.get("weights") or {}), float(get(widget, "default_weight", 1.0)), float(get(widget, "unknown_weight", 1.0)), get(widget, "use", "target")),
            ),
            time_decay=TimeDecay(bool(time.get("enabled", False)), time.get("strategy") or "none", _table(time.get("weight_by_age_days"), TIME_WEIGHTS), float(get(time, "exponential.half_life_days", 7)), float(get(time, "exponential.min_weight", 0.05))),
            scorer=Scorer(
                method=get(c, "scoring.method", "pair_count"), business_weights=get(c, "scoring.business_weights", BUSINESS_WEIGHTS), action_shares=get(c, "scoring.calibration.action_shares_used_for_calibration"), beta=float(get(c, "scoring.beta", 0.5)),
                reference_action_type=get(c, "scoring.reference_action_type", "view"), max_frequency_boost=get(c, "scoring.max_frequency_boost", MAX_FREQUENCY_BOOST), min_pair_count=int(get(c, "scoring.min_pair_count", 1)), min_unique_users=int(get(c, "scoring.min_unique_users", 1)),
                min_unique_sessions=int(get(c, "scoring.min_unique_sessions", 1)), count_source=get(c, "scoring.count_source", "raw"), count_transform=get(c, "scoring.count_transform.method", "log"), smoothing=float(get(c, "scoring.count_transform.smoothing", 1.0)),
                min_weighted_pair_count=get(c, "scoring.min_weighted_pair_count"), min_score=get(c, "scoring.min_score"), normalize_by_popularity=bool(get(c, "scoring.normalize_by_item_popularity", False)),
                popularity_column=get(c, "scoring.popularity_normalization.popularity_column", "unique_users"), popularity_smoothing=float(get(c, "scoring.popularity_normalization.smoothing", 1.0)), popularity_power=float(get(c, "scoring.popularity_normalization.power", 0.5)),
            ),
            topk=TopK(top_k, get(c, "topk.source", "behavioral"), get(c, "topk.min_pair_count"), get(c, "topk.min_unique_users"), get(c, "topk.min_unique_sessions"), deduplicate=False),
            fallback=FallbackSettings.from_config(c, top_k),
            relevance_mode=get(c, "evaluation.relevance_mode", "binary"),
            relevance_weights=get(c, "evaluation.relevance_weights"),
            ranking_actions=tuple(ranking) if ranking is not None else None,
            min_ranking_relevance=get(c, "evaluation.min_ranking_relevance", 0.3),
            allow_empty_input=bool(get(c, "pipeline.allow_empty_input", False)),
        )
