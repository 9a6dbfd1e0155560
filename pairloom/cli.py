"""Command line: ``python -m pairloom.cli run|score|tune|compare|preview …``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from pairloom.config import load, override
from pairloom.operators.eda import preview
from pairloom.operators.cleaning import clean_events
from pairloom.output.writers import write_preview
from pairloom.plans import tuning
from pairloom.plans.recommend import run, score
from pairloom.sources.events import scan_events, scan_products


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="pairloom")
    commands = parser.add_subparsers(dest="command", required=True)
    r = commands.add_parser("run", help="recommend, and evaluate if validation days are given")
    for name in ("--events", "--config", "--train-until", "--output", "--run-id"):
        r.add_argument(name, required=True)
    r.add_argument("--products")
    r.add_argument("--lookback-days", type=int)
    r.add_argument("--top-k", type=int)
    r.add_argument("--validation-days", type=int, default=0)
    r.add_argument("--latest")
    p = commands.add_parser("preview", help="export the first lists as CSV and JSON")
    for name in ("--recommendations", "--output"):
        p.add_argument(name, required=True)
    p.add_argument("--products", help="a catalogue, for the names of items")
    p.add_argument("--items", type=int, default=20)
    p.add_argument("--top-k", type=int, default=10)
    s = commands.add_parser("score", help="scores, lists and outputs from the artifacts of earlier runs, without events")
    for name in ("--artifacts", "--config", "--train-until", "--output", "--run-id"):
        s.add_argument(name, required=True)
    s.add_argument("--products")
    s.add_argument("--latest")
    t = commands.add_parser("tune", help="search for settings")
    for name in ("--events", "--config", "--tuning", "--train-until", "--output"):
        t.add_argument(name, required=True)
    t.add_argument("--products")
    t.add_argument("--validation-days", type=int, default=1)
    c = commands.add_parser("compare", help="best trials of sweeps")
    c.add_argument("--tuning", required=True)
    c.add_argument("sweeps", nargs="+")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("pairloom").getOrCreate()
    if a.command == "preview":
        catalogue = scan_products(spark, a.products) if a.products else None
        write_preview(preview(spark.read.parquet(a.recommendations), a.items, a.top_k, catalogue), a.output)
        return 0
    if a.command == "score":
        catalogue = scan_products(spark, a.products) if a.products else None
        print(score(a.artifacts, catalogue, load(a.config), a.train_until, a.output, a.run_id, a.latest).manifest)
        return 0
    if a.command == "compare":
        for row in tuning.compared(a.sweeps, load(a.tuning)["objective"]):
            print(json.dumps(row, default=str))
        return 0
    if a.command == "tune":
        config, catalogue = load(a.config), scan_products(spark, a.products) if a.products else None
        best = tuning.tune(clean_events(scan_events(spark, a.events)), catalogue, config, load(a.tuning), a.train_until, a.validation_days, a.output)
        print(json.dumps(best, default=str))
        return 0
    changes = {"pipeline.lookback_days": a.lookback_days} if a.lookback_days else {}
    if a.top_k:
        changes |= {"topk.top_k": a.top_k, "pipeline.top_k": a.top_k, "business.fallback.top_k": a.top_k}
    products = scan_products(spark, a.products) if a.products else None
    result = run(scan_events(spark, a.events), products, override(load(a.config), changes), a.train_until, a.output, a.run_id, a.validation_days, a.latest)
    print(result.manifest)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
