"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from pairloom.operators.cleaning import clean_events
from pairloom.operators.fallback import FallbackSettings, merge_fallback
from pairloom.operators.pairs import item_pairs
from pairloom.operators.popularity import item_popularity
from pairloom.operators.sessions import build_sessions
from pairloom.operators.aggregate import aggregate_window
from pairloom.operators.scoring import Scorer
from pairloom.operators.topk import TopK
from pairloom.sources.adapters import basket_events, products

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def _pairs(spark, d):
    return item_pairs(build_sessions(clean_events(basket_events(spark, d)), 30))


def _top(spark, d):
    return TopK(deduplicate=False).select(Scorer().score(aggregate_window(_pairs(spark, d), "1992-01-01", "1998-12-31")))


HEADLINE = {
    "sessions": lambda s, d: build_sessions(clean_events(basket_events(s, d)), 30),
    "item_pairs": _pairs,
    "window_aggregate": lambda s, d: aggregate_window(_pairs(s, d), "1992-01-01", "1998-12-31"),
    "topk": _top,
    "fallback": lambda s, d: merge_fallback(_top(s, d), item_popularity(clean_events(basket_events(s, d))), products(s, d), FallbackSettings(enabled=True, enable_global=False)),
    "item_popularity": lambda s, d: item_popularity(clean_events(basket_events(s, d))),
}


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = dict(HEADLINE)
    try:
        from pairloom.llm.queries import QUERIES
    except ImportError:
        QUERIES = {}
    found |= {k: f for k, f in QUERIES.items() if k.startswith("op")}
    HEADLINE["sessions"](spark, SF_DIR).write.format("noop").mode("overwrite").save()  # starts the JVM's and workers' code, untimed
    seconds: dict[str, float] = {}
    for name, query in found.items():
        began = time.perf_counter()
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    total = round(sum(v for k, v in seconds.items() if k in HEADLINE), 3)
    print(json.dumps({"metric": "seconds of the headline queries", "value": total, "unit": "sec", "queries": seconds, "sf": SF_DIR.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
