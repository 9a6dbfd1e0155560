import datetime as dt
import uuid

import pytest
from helpers import clean, same_rows, ts
from pyspark.sql import functions as F
from test_artifacts import random_events
from test_runs import raw

from pairloom.operators.aggregate import aggregate_window
from pairloom.operators.cleaning import clean_events
from pairloom.operators.pairs import PairSettings, item_pairs, session_items
from pairloom.operators.placing import placed_in_ranges
from pairloom.operators.popularity import item_popularity
from pairloom.operators.scoring import Scorer
from pairloom.operators.sessions import build_sessions
from pairloom.operators.topk import TopK
from pairloom.plans.layout import aggregates_in_buckets, clean_in_buckets, open_buckets


def exchanges(df):
    return df._jdf.queryExecution().toString().partition("== Physical Plan ==")[2].count("Exchange")


def same(a, b):
    same_rows([tuple(r) for r in a.collect()], a.columns, [tuple(r) for r in b.collect()], b.columns)


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def test_users_in_buckets_share_one_shuffle(spark, tmp_path, name):
    events = raw(spark, random_events())
    table = clean_in_buckets(events, name, f"{tmp_path}/clean", 4)
    same(table, clean_events(events))
    sessions = build_sessions(table, 60)
    assert exchanges(sessions) == 0
    same(sessions, build_sessions(clean_events(events), 60))
    assert exchanges(table.groupBy("item_id", "user_id").count()) == 0
    same(item_popularity(table), item_popularity(clean_events(events)))
    again = open_buckets(spark, f"{name}_again", f"{tmp_path}/clean", "user_id", 4, ("timestamp", "item_id", "action_type"))
    assert exchanges(build_sessions(again, 60)) == 0
    same(build_sessions(again, 60), sessions)


def test_items_in_buckets_are_ranked_without_a_shuffle(spark, tmp_path, name):
    aggregates = aggregate_window(item_pairs(build_sessions(clean(spark, random_events()), 180)), "2024-03-01", "2024-03-03")
    table = aggregates_in_buckets(aggregates, name, f"{tmp_path}/pairs", 4)
    top = TopK(3, deduplicate=False).select(Scorer().score(table))
    assert exchanges(top) == 0
    same(top, TopK(3, deduplicate=False).select(Scorer().score(aggregates)))


def test_places_in_ranges(spark):
    """A group with nearly all rows, repeated rows and nulls."""
    df = spark.range(3000).select(F.when(F.col("id") < 2900, 1).otherwise(F.col("id")).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id") % 500).alias("x"))
    rows = placed_in_ranges(df, ["k"], ["x"], "place").collect()
    assert len(rows) == 3000
    mine = sorted((r["place"], -1 if r["x"] is None else r["x"]) for r in rows if r["k"] == 1)
    assert [p for p, _ in mine] == list(range(1, 2901))
    assert [x for _, x in mine] == sorted(x for _, x in mine)


def session_rows(spark, user, events):
    """(item, action) events of one session a second apart."""
    return [(user, ts(1, "10:00") + dt.timedelta(seconds=k), a, i) for k, (i, a) in enumerate(events)]


def test_a_giant_session_is_no_tasks_alone(spark):
    """One session with most of the events and few items, one with too many items, and ordinary ones."""
    giant = [(k % 20, "click" if k % 3000 == 5 else "view") for k in range(20_000)]
    rows = session_rows(spark, 1, giant) + session_rows(spark, 2, [(k, "view") for k in range(2000)]) + session_rows(spark, 3, [(1, "view"), (2, "to_cart")])
    sessions = build_sessions(clean(spark, rows), 30)
    for most in (50, 10):
        settings = PairSettings(max_items_per_session=most)
        same(session_items(sessions, settings, heavy_events=1000), session_items(sessions, settings))
    ranges = placed_in_ranges(sessions.filter("user_id = 1").select("user_id", "session_index", "timestamp"), ["user_id", "session_index"], ["timestamp"], "place")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = sessions.filter("user_id = 1").repartitionByRange("user_id", "session_index", "timestamp").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in dealt) < 20_000 / 3  # of 8 tasks
    assert ranges.agg(F.max("place")).first()[0] == 20_000
