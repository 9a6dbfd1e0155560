import pytest
from helpers import clean, same_rows, ts
from pyspark.sql import functions as F

from pairloom.functions.decay import TimeDecay
from pairloom.operators.aggregate import aggregate_window
from pairloom.operators.bitmaps import aggregate_window_from_sets, daily_sets, unique_users, user_codes
from pairloom.operators.pairs import daily_pair_stats, item_pairs
from pairloom.operators.sessions import build_sessions


def sessions(spark):
    """One pair that all users have on several days, some that few have."""
    rows = [(u, ts(day, f"{10 + u % 3}:{k:02d}"), a, i) for u in range(40) for day in (1, 2, 5) if (u + day) % 3 for k, (i, a) in enumerate([(10, "view"), (20, "click"), (30 + u // 2, "to_cart")])]
    return build_sessions(clean(spark, rows), 30)


@pytest.mark.parametrize("full", [1, 3, 10, 1024])
@pytest.mark.parametrize("window", [("2024-03-01", "2024-03-05"), ("2024-03-02", "2024-03-02"), ("2024-04-01", "2024-04-02")])
def test_equals_the_aggregates_of_raw_pairs(spark, full, window):
    """Lists alone, bitmaps alone, and buckets that are a list on one day and a bitmap on another."""
    s = sessions(spark)
    decay = TimeDecay(True, "exponential")
    sets = daily_sets(daily_pair_stats(s), user_codes(s), full)
    got, expected = aggregate_window_from_sets(sets, *window, decay), aggregate_window(item_pairs(s), *window, decay)
    same_rows([tuple(r) for r in got.collect()], got.columns, [tuple(r) for r in expected.collect()], expected.columns)


def test_users_of_several_buckets(spark):
    """Codes beyond a bucket's 32768."""
    rows = [("2024-03-01", 1, 2, 10), ("2024-03-02", 1, 2, 10), ("2024-03-02", 1, 2, 40_000), ("2024-03-02", 1, 3, 70_000)]
    keys = spark.createDataFrame(rows, "pair_date string, item_id long, similar_item_id long, user_id long")
    daily = daily_pair_stats(sessions(spark))
    codes = spark.createDataFrame([(u, u) for u in (10, 40_000, 70_000)], "user_id long, code long")
    for full in (1, 1024):
        sets = daily_sets(type(daily)(daily.counts, daily.widget_counts, keys, daily.session_keys), codes, full)
        assert {(r[0], r[1]): r[2] for r in unique_users(sets.users).collect()} == {(1, 2): 2, (1, 3): 1}


def test_codes_are_dense_and_stay(spark):
    first = user_codes(spark.createDataFrame([(u,) for u in (7, 3, 3, None, 9)], "user_id long"))
    assert sorted(r["code"] for r in first.collect()) == [0, 1, 2]
    more = user_codes(spark.range(0, 500).select(F.col("id").alias("user_id")), first)
    codes = {r["user_id"]: r["code"] for r in more.collect()}
    assert sorted(codes.values()) == list(range(500))
    assert {r["user_id"]: r["code"] for r in first.collect()}.items() <= codes.items()
    assert user_codes(spark.createDataFrame([], "user_id long")).count() == 0
