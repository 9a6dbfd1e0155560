import datetime as dt

import pytest
from helpers import clean, ts
from pyspark.sql import functions as F

from pairloom.config import Settings
from pairloom.functions.decay import DistanceDecay, TimeDecay, WidgetContext
from pairloom.operators.aggregate import aggregate_window, aggregate_window_from_daily
from pairloom.operators.cleaning import clean_events
from pairloom.operators.pairs import PairSettings, daily_pair_stats, item_pairs, session_items
from pairloom.operators.sessions import build_sessions, build_sessions_by_day

BUILDERS = [build_sessions, build_sessions_by_day]


def indices(df):
    return [r["session_index"] for r in df.orderBy("timestamp").collect()]


@pytest.mark.parametrize("build", BUILDERS)
@pytest.mark.parametrize(
    ("times", "expected"),
    [
        ([(1, "00:00"), (1, "00:10"), (1, "00:45")], [1, 1, 2]),
        ([(1, "23:50"), (1, "23:55"), (2, "00:05")], [1, 1, 1]),
        ([(1, "23:50"), (2, "00:25")], [1, 2]),
        ([(1, "10:00"), (1, "10:30")], [1, 1]),
        ([(1, "23:00"), (2, "10:00"), (2, "10:05"), (4, "10:00")], [1, 2, 2, 3]),
    ],
)
def test_gaps(spark, build, times, expected):
    df = build(clean(spark, [(1, ts(*t), "view", k) for k, t in enumerate(times)]), 30)
    assert indices(df) == expected


@pytest.mark.parametrize("build", BUILDERS)
def test_session_starts_on_its_first_day(spark, build):
    df = build(clean(spark, [(1, ts(1, "23:50"), "view", 1), (1, ts(2, "00:05"), "view", 2), (1, ts(2, "00:20"), "view", 3)]), 30)
    assert {r["session_start_date"] for r in df.collect()} == {dt.date(2024, 3, 1)}


@pytest.mark.parametrize("build", BUILDERS)
def test_no_events_and_bad_timeout(spark, build):
    assert build(clean(spark, []), 30).count() == 0
    with pytest.raises(ValueError, match="positive"):
        build(clean(spark, []), 0)


def test_cleaning(spark):
    rows = [
        (1, dt.date(2024, 3, 9), "2024-03-01 10:00:00", "view", None, None, 5),
        (1, dt.date(2024, 3, 9), "2024-03-01 10:00:00", "view", None, None, 5),
        (1, dt.date(2024, 3, 9), "not a time", "view", "w", None, 5),
        (None, dt.date(2024, 3, 9), "2024-03-01 10:00:00", "view", "w", None, 5),
        (1, dt.date(2024, 3, 9), "2024-03-01 10:00:00", "search", "w", "q", 5),
        (1, dt.date(2024, 3, 9), "2024-03-01 10:00:00", "view", "w", None, None),
    ]
    raw = spark.createDataFrame(rows, "user_id long, date date, timestamp string, action_type string, widget_name string, search_query string, item_id long")
    (row,) = clean_events(raw).collect()
    assert (row["event_date"], row["widget_name"], row["item_id"]) == (dt.date(2024, 3, 1), "unknown", 5)
    with pytest.raises(ValueError, match="missing expected columns"):
        clean_events(raw.drop("item_id"))


def basket(spark, *items):
    return build_sessions(clean(spark, [(1, ts(1, f"10:{k:02d}"), a, i, *w) for k, (i, a, *w) in enumerate(items)]), 30)


def test_pairs(spark):
    pairs = {(r["item_id"], r["similar_item_id"]): r for r in item_pairs(basket(spark, (10, "view"), (20, "to_cart"), (30, "view"))).collect()}
    assert len(pairs) == 6
    assert (pairs[10, 20]["signal_type"], pairs[20, 10]["signal_type"]) == ("to_cart", "view")
    assert pairs[10, 30]["position_distance"] == 2


def test_strongest_action_and_session_size(spark):
    sessions = basket(spark, (10, "view"), (10, "to_cart", "cart"), (20, "click"))
    items = {r["item_id"]: r for r in session_items(sessions).collect()}
    assert (items[10]["item_action_type"], items[10]["item_widget_name"], items[10]["event_position"]) == ("to_cart", "cart", 1)
    assert session_items(basket(spark, (10, "view"), (10, "click"))).count() == 0
    assert session_items(basket(spark, (1, "view"), (2, "view"), (3, "view")), PairSettings(max_items_per_session=2)).count() == 0
    with pytest.raises(ValueError, match="at least 2"):
        PairSettings(max_items_per_session=1)


@pytest.mark.parametrize(
    ("decay", "near", "far"),
    [
        (DistanceDecay(True, "weight_table", table={1: 1.0, 2: 0.5}), 1.0, 0.5),
        (DistanceDecay(True, "exponential", alpha=10, min_weight=0.4), 1.0, 0.4),
        (DistanceDecay(False, "exponential", alpha=10), 1.0, 1.0),
        (DistanceDecay(True, "weight_table", table={2: 0.5, "default": 0.1}), 0.1, 0.5),
        (DistanceDecay(True, "weight_table", table={1: 0.5}), 0.5, 1.0),  # beyond a table without a default
    ],
)
def test_distance_decay(spark, decay, near, far):
    pairs = {(r["item_id"], r["similar_item_id"]): r["graph_weight"] for r in item_pairs(basket(spark, (10, "view"), (20, "view"), (30, "view")), PairSettings(distance_decay=decay)).collect()}
    assert (pairs[10, 20], pairs[10, 30]) == (near, far)


@pytest.mark.parametrize(("enabled", "n"), [(True, 4), (False, 6)])
def test_max_distance(spark, enabled, n):
    assert item_pairs(basket(spark, (10, "view"), (20, "view"), (30, "view")), PairSettings(distance_decay=DistanceDecay(enabled, max_distance=1))).count() == n


def test_widget_weight(spark):
    context = WidgetContext(True, {"search_results": 2.0})
    pairs = {(r["item_id"], r["similar_item_id"]): r["graph_weight"] for r in item_pairs(basket(spark, (10, "view", "x"), (20, "click", " search_results ")), PairSettings(widget_context=context)).collect()}
    assert pairs == {(10, 20): 2.0, (20, 10): 1.0}
    with pytest.raises(ValueError, match="target"):
        WidgetContext(use="both")


def test_widget_of_the_source(spark):
    context = WidgetContext(True, {"search_results": 2.0}, unknown_weight=0.5, use="source")
    pairs = {(r["item_id"], r["similar_item_id"]): r["graph_weight"] for r in item_pairs(basket(spark, (10, "view", "  "), (20, "click", "search_results")), PairSettings(widget_context=context)).collect()}
    assert pairs == {(10, 20): 0.5, (20, 10): 2.0}


@pytest.mark.parametrize("table", [{}, {"default": 0.5}, {-1: 0.5}, {1: 1.5}, {1: -0.1}, {1: 0.5, "default": 2.0}])
def test_weight_tables_are_checked(table):
    with pytest.raises(ValueError, match="weight table"):
        DistanceDecay(table=table)


@pytest.mark.parametrize("weights", [{"": 1.0}, {"x": -1.0}])
def test_widget_weights_are_checked(weights):
    with pytest.raises(ValueError, match="negative"):
        WidgetContext(weights=weights)
    with pytest.raises(ValueError, match="blocked_widgets"):
        Settings.from_config({"graph": {"widget_context": {"blocked_widgets": ["x"]}}})


def test_time_decay_and_the_two_aggregates_agree(spark):
    events = [(u, ts(day, f"10:{k:02d}"), a, i) for u in (1, 2, 3) for day in (1, 2, 5) for k, (i, a) in enumerate([(10, "view"), (20, "click"), (30 + u, "to_cart")])]
    sessions = build_sessions(clean(spark, events), 30)
    for decay in (TimeDecay(), TimeDecay(True, "weight_table", {0: 1.0, 1: 0.5, "default": 0.1}), TimeDecay(True, "exponential", half_life_days=1, min_weight=0.75)):
        raw = aggregate_window(item_pairs(sessions), "2024-03-01", "2024-03-02", decay)
        daily = daily_pair_stats(sessions)
        compact = aggregate_window_from_daily(daily.counts, daily.user_keys, daily.session_keys, "2024-03-01", "2024-03-02", decay)
        assert sorted(map(repr, raw.collect())) == sorted(map(repr, compact.collect()))
        row = raw.filter("item_id = 10 AND similar_item_id = 20").first()
        assert (row["pair_count"], row["click_count"], row["unique_users"], row["unique_sessions"]) == (6, 6, 3, 6)
        expected = {"none": 6.0, "weight_table": 4.5, "exponential": 5.25}[decay.strategy]
        assert row["weighted_pair_count"] == pytest.approx(expected)
    with pytest.raises(ValueError, match="after its end"):
        aggregate_window(item_pairs(sessions), "2024-03-02", "2024-03-01")
    with pytest.raises(ValueError, match="bucket"):
        aggregate_window_from_daily(daily.counts, daily.user_keys, daily.session_keys, "2024-03-01", "2024-03-02", item_bucket=(2, 2))
    parts = [aggregate_window_from_daily(daily.counts, daily.user_keys, daily.session_keys, "2024-03-01", "2024-03-02", item_bucket=(b, 3)) for b in range(3)]
    assert sum(p.count() for p in parts) == raw.count()


def test_day_by_day_sessions_equal_whole_ones(spark):
    import random

    rnd = random.Random(4)
    events = [(rnd.randint(1, 5), ts(rnd.randint(1, 6), "00:00") + dt.timedelta(seconds=rnd.randint(0, 86399)), "view", rnd.randint(1, 9)) for _ in range(600)]
    a, b = (build(clean(spark, events), 45).orderBy("user_id", "timestamp", "item_id").collect() for build in BUILDERS)
    assert a == b
    assert F is not None
