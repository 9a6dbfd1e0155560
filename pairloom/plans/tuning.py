"""Search for settings: trials share the tables that their parameters don't touch."""

from __future__ import annotations

import csv
import io
import json
import math
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from decimal import Decimal
from itertools import islice, product
from typing import Any

from pairloom.output.writers import write_manifest
from pairloom.sources.files import exists, folders, joined, read_text, staged, write_text

Params = dict[str, Any]
#: Parameters that only the last steps read.
SCORING_ONLY = ("scoring.", "topk.", "business.fallback.")
#: Trials of one pass.
TOGETHER = 50


def values(spec: Mapping[str, Any]) -> list[Any]:
    """Grid values of a parameter: of a choice, an int_range, a float_range with a step, or ``num`` of a log_float_range."""
    kind = spec.get("type", "choice")
    if kind == "choice":
        if not isinstance(spec.get("values"), list) or not spec["values"]:
            raise ValueError("a choice needs a list of values")
        return list(spec["values"])
    if kind not in ("int_range", "float_range", "log_float_range"):
        raise ValueError(f"unknown type of parameter: {kind}")
    low, high = spec["min"], spec["max"]
    if low > high:
        raise ValueError("min must not be above max")
    if kind == "log_float_range":
        n = int(spec.get("num", 3))
        if n < 1 or low <= 0:
            raise ValueError("a log_float_range needs positive bounds and num")
        return [float(low)] if n == 1 else [round(math.exp(math.log(low) + math.log(high / low) * k / (n - 1)), 12) for k in range(n)]
    step = spec.get("step", 1 if kind == "int_range" else None)
    if step is None or step <= 0:
        raise ValueError(f"a grid of a {kind} needs a positive step")
    if kind == "int_range":
        return list(range(int(low), int(high) + 1, int(step)))
    first, width = Decimal(str(float(low))), Decimal(str(float(step)))
    return [float(first + width * k) for k in range(int((Decimal(str(float(high))) - first) / width) + 1)]


def draw(spec: Mapping[str, Any], rng: random.Random) -> Any:
    """A random value; float ranges without a step and log_float_ranges are continuous."""
    kind = spec.get("type", "choice")
    if kind == "log_float_range":
        values(spec)
        return round(math.exp(rng.uniform(math.log(spec["min"]), math.log(spec["max"]))), 12)
    if kind == "float_range" and spec.get("step") is None:
        return round(rng.uniform(float(spec["min"]), float(spec["max"])), 12)
    return rng.choice(values(spec))


def grid(space: Mapping[str, Mapping[str, Any]], trials: int | None = None) -> Iterator[Params]:
    for k, combo in enumerate(product(*(values(s) for s in space.values()))):
        if trials is not None and k >= trials:
            return
        yield dict(zip(space, combo, strict=True))


def sampled(space: Mapping[str, Mapping[str, Any]], trials: int, seed: int | None = None) -> Iterator[Params]:
    """Random trials, each once as long as new ones turn up."""
    rng, seen = random.Random(seed), set()
    for _ in range(trials):
        for _ in range(100):
            p = {k: draw(s, rng) for k, s in space.items()}
            if (key := json.dumps(p, sort_keys=True)) not in seen:
                break
        seen.add(key)
        yield p


def objective(metrics: Mapping[str, float | None], spec: Mapping[str, Any]) -> float | None:
    """Primary times the geometric mean of primary, supporting metrics and what penalties leave; None if a constraint fails.

    Constraints are ``min_`` or ``max_`` and a metric; a metric that is missing counts as 0.
    """
    for name, bound in (spec.get("constraints") or {}).items():
        side, _, metric = name.partition("_")
        if side not in ("min", "max") or not metric:
            raise ValueError(f"a constraint must start with min_ or max_, unlike {name}")
        value = metrics.get(metric) or 0.0
        if value < bound if side == "min" else value > bound:
            return None
    clamp = lambda x: min(1.0, max(0.0, x or 0.0))
    primary = clamp(metrics.get(spec["primary"]))
    parts = [primary, *(clamp(metrics.get(m)) for m in spec.get("supporting", ())), *(1 - clamp(metrics.get(m)) for m in spec.get("penalties", ()))]
    return 0.0 if min(parts) == 0 else primary * math.exp(sum(map(math.log, parts)) / len(parts))


def best(results: Sequence[Mapping[str, Any]], spec: Mapping[str, Any]) -> Mapping[str, Any] | None:
    eligible = [r for r in results if r.get("objective") is not None]
    return max(eligible, key=lambda r: (r["objective"], r["metrics"].get(spec["primary"]) or 0.0, r["metrics"].get("strong_ndcg_at_k") or 0.0, r["trial_id"]), default=None)


def is_scoring_only(space: Mapping[str, Any]) -> bool:
    return all(k.startswith(SCORING_ONLY) for k in space)


class Sweep:
    """Trials with their results, written after each one, so that a broken sweep can go on."""

    def __init__(self, evaluate: Callable[[Params], Mapping[str, float | None]], spec: Mapping[str, Any], folder: str) -> None:
        self.evaluate, self.spec, self.folder = evaluate, spec, folder
        self.results: list[dict[str, Any]] = []

    def trial(self, params: Params) -> dict[str, Any]:
        return self.add(params, self.evaluate(params))

    def add(self, params: Params, metrics: Mapping[str, float | None]) -> dict[str, Any]:
        trial_id, metrics = f"trial_{len(self.results):04d}", dict(metrics)
        result = {"trial_id": trial_id, "params": params, "metrics": metrics, "objective": objective(metrics, self.spec)}
        self.results.append(result)
        write_manifest(joined(self.folder, "trials", trial_id, "metrics.json"), result)
        self.checkpoint()
        return result

    def checkpoint(self) -> None:
        rows = [{"trial_id": r["trial_id"], "objective": r["objective"], **r["params"], **r["metrics"]} for r in self.results]
        text = io.StringIO(newline="")
        writer = csv.DictWriter(text, list(dict.fromkeys(k for r in rows for k in r)))
        writer.writeheader()
        writer.writerows(rows)
        write_text(joined(self.folder, "results.csv"), text.getvalue())
        top = best(self.results, self.spec)
        write_manifest(joined(self.folder, "summary.json"), {"trials": len(rows), "best": top})
        if top:
            write_manifest(joined(self.folder, "best_metrics.json"), top["metrics"])
            for name in ("best_config.json", "best_config.yaml"):  # JSON is YAML too
                write_manifest(joined(self.folder, name), top["params"])

    def run(self, trials: Iterator[Params]) -> Mapping[str, Any] | None:
        for p in trials:
            self.trial(p)
        return best(self.results, self.spec)

    def together(self, trials: Iterator[Params], evaluate: Callable[[Sequence[Params]], Sequence[Mapping[str, float | None]]], size: int = TOGETHER) -> Mapping[str, Any] | None:
        """Trials that an evaluator takes several at once."""
        while some := list(islice(trials, size)):
            for params, metrics in zip(some, evaluate(some), strict=True):
                self.add(params, metrics)
        return best(self.results, self.spec)

    def halving(self, candidates: Sequence[Params], cheap: Callable[[Params], Mapping[str, float | None]], factor: int = 3) -> Mapping[str, Any] | None:
        """Candidates on a cheap run first; the best part of them in full."""
        scored = [(objective(cheap(p), self.spec), k) for k, p in enumerate(candidates)]
        ranked = sorted((s for s in scored if s[0] is not None), reverse=True)
        return self.run(candidates[k] for _, k in ranked[: math.ceil(len(candidates) / factor)])

    def annealing(self, space: Mapping[str, Mapping[str, Any]], trials: int, start: float = 1.0, end: float = 0.01, seed: int | None = None) -> Mapping[str, Any] | None:
        """One parameter changes at a time; worse results are taken with a chance that falls with the temperature."""
        rng = random.Random(seed)
        now = {k: draw(s, rng) for k, s in space.items()}
        value = self.trial(now)["objective"] or 0.0
        for k in range(1, trials):
            heat = start * (end / start) ** (k / max(1, trials - 1))
            name = rng.choice(list(space))
            step = {**now, name: draw(space[name], rng)}
            new = self.trial(step)["objective"] or 0.0
            if new >= value or rng.random() < math.exp((new - value) / heat):
                now, value = step, new
        return best(self.results, self.spec)


def recover(folder: str, spec: Mapping[str, Any]) -> Sweep:
    """A sweep from the results of its trials."""
    sweep = Sweep(lambda p: {}, spec, folder)
    for name in folders(joined(folder, "trials")):
        path = joined(folder, "trials", name, "metrics.json")
        if not exists(path):  # the trial was broken off
            continue
        r = json.loads(read_text(path))
        sweep.results.append({**r, "objective": objective(r["metrics"], spec)})
    if sweep.results:
        sweep.checkpoint()
    return sweep


def scoring_trials(clean, sessions, popularity, distribution, aggregates, products, truth, config) -> Callable[[Params], Mapping[str, float | None]]:  # noqa: ANN001
    """An evaluator for parameters of the last steps: aggregates, popularity and truth are kept once for all trials."""
    from pairloom.config import Settings, override
    from pairloom.operators.evaluation import offline_metrics
    from pairloom.plans.recommend import score_and_rank

    aggregates, popularity, distribution, truth = staged(aggregates), staged(popularity), staged(distribution), staged(truth)

    def evaluate(params: Params) -> Mapping[str, float | None]:
        if not is_scoring_only(params):
            raise ValueError("only parameters of scoring, topk and fallback can vary here")
        settings = Settings.from_config(override(config, params))
        plan = score_and_rank(clean, sessions, popularity, distribution, aggregates, products, settings)
        return offline_metrics(plan.recommendations, truth, settings.topk.top_k, popularity, settings.ranking_actions, settings.min_ranking_relevance).as_dict()

    return evaluate


def trials_of(clean, products, config, train_until: str, validation_days: int, lookback_days: int | None = None) -> Callable[[Params], Mapping[str, float | None]]:  # noqa: ANN001
    """An evaluator of whole runs; ``lookback_days`` shortens them for the cheap turn of halving. The truth is made once."""
    from pairloom.config import Settings, override
    from pairloom.operators.evaluation import offline_metrics
    from pairloom.plans.recommend import recommend, validation_truth

    truth = staged(validation_truth(clean, config, train_until, validation_days))

    def evaluate(params: Params) -> Mapping[str, float | None]:
        changes = {**params, **({"pipeline.lookback_days": lookback_days} if lookback_days else {})}
        settings = Settings.from_config(override(config, changes))
        plan = recommend(clean, products, settings, train_until)
        return offline_metrics(staged(plan.recommendations), truth, settings.topk.top_k, plan.popularity, settings.ranking_actions, settings.min_ranking_relevance).as_dict()

    return evaluate


def tune(clean, products, config, tuning: Mapping[str, Any], train_until: str, validation_days: int, folder: str) -> Mapping[str, Any] | None:  # noqa: ANN001
    """The sweep that ``tuning`` asks for: space, objective, method (grid, random, halving, annealing), trials and seed.

    Where only the last steps vary, trials share everything before them, and those of grids and random searches are evaluated
    many in one pass. Halving tries candidates on one day of training
    and one of validation first. The best whole configuration is written as ``best_full_config.json``.
    """
    from pairloom.config import Settings, override
    from pairloom.plans.recommend import recommend, validation_truth
    from pairloom.plans.trials import evaluate_trials

    space, spec, method = tuning["space"], tuning["objective"], tuning.get("method", "grid")
    trials, seed = int(tuning.get("trials", 20)), tuning.get("seed")
    many = None
    if is_scoring_only(space) and method != "halving":
        plan = recommend(clean, products, Settings.from_config(override(config, {f"scoring.min_{c}": 1 for c in ("pair_count", "unique_users", "unique_sessions")})), train_until)
        if method in ("grid", "random"):
            shared = [staged(df) for df in (plan.aggregates, plan.popularity, plan.distribution)]
            truth = staged(validation_truth(clean, config, train_until, validation_days))
            many = lambda some: [m.as_dict() for m in evaluate_trials(*shared, products, truth, config, some)]
    if many is not None:
        evaluate = lambda p: many([p])[0]
    elif is_scoring_only(space) and method != "halving":
        evaluate = scoring_trials(clean, plan.sessions, plan.popularity, plan.distribution, plan.aggregates, products, validation_truth(clean, config, train_until, validation_days), config)
    else:
        evaluate = trials_of(clean, products, config, train_until, validation_days)
    sweep = Sweep(evaluate, spec, folder)
    if method == "annealing":
        top = sweep.annealing(space, trials, seed=seed)
    elif method == "halving":
        top = sweep.halving(list(sampled(space, trials, seed)), trials_of(clean, products, config, train_until, 1, lookback_days=1))
    elif method in ("grid", "random"):
        asked = grid(space, tuning.get("trials")) if method == "grid" else sampled(space, trials, seed)
        top = sweep.together(asked, many) if many is not None else sweep.run(asked)
    else:
        raise ValueError(f"unknown method {method}")
    if top:
        for name in ("best_full_config.json", "best_full_config.yaml"):  # JSON is YAML too
            write_manifest(joined(folder, name), override(config, top["params"]))
    return top


def compared(folders_: Sequence[str], spec: Mapping[str, Any]) -> list[dict[str, Any]]:
    """The best trial of each finished sweep, from the best down."""
    rows = []
    for folder in folders_:
        results = recover(folder, spec).results
        if top := best(results, spec):
            rows.append({"sweep": folder, "trials": len(results), **top})
    return sorted(rows, key=lambda r: -r["objective"])
