"""Pair aggregates over an inclusive window of dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.decay import TimeDecay
from pairloom.operators.pairs import PAIR, count_columns, with_graph_weight
from pairloom.schemas import CONTRACTS, RAW_COUNTS, WEIGHTED_COUNTS


def within_window(df: DataFrame, start: str, end: str) -> DataFrame:
    if date.fromisoformat(start) > date.fromisoformat(end):
        raise ValueError("the window's start is after its end")
    day = F.col("pair_date").try_cast("date")
    return df.withColumn("pair_date", day).filter(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def _age(end: str) -> Column:
    return F.datediff(F.lit(end).cast("date"), F.col("pair_date"))


def named_window(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.withColumn("window_start", F.lit(start)).withColumn("window_end", F.lit(end)).select(*CONTRACTS["pair_aggregates"])


def with_weighted_counts(df: DataFrame) -> DataFrame:
    """Tables written before weights existed: weighted counts are the raw ones."""
    return df.withColumns({w: F.col(r).cast("double") for r, w in zip(RAW_COUNTS, WEIGHTED_COUNTS, strict=True) if w not in df.columns})


def aggregate_window(pairs: DataFrame, start: str, end: str, time_decay: TimeDecay = TimeDecay()) -> DataFrame:
    """From raw pairs.

    Pairs are dealt once by pair and user: sessions and users are then counted by plain sums, and a pair that very many
    users share goes to its total as one row for each of them. Distinct counts beside sums would write every row thrice.
    """
    weight, sums = F.col("graph_weight") * time_decay.weight(_age(end)), [*RAW_COUNTS, *WEIGHTED_COUNTS]
    total = [F.sum(c).alias(c) for c in sums]
    dealt = with_graph_weight(within_window(pairs, start, end)).repartition(*PAIR, "user_id")
    of_session = dealt.groupBy(*PAIR, "user_id", "session_index").agg(*count_columns(weight))
    one = F.when(F.col("user_id").isNotNull() & F.col("session_index").isNotNull(), 1).otherwise(0)
    of_user = of_session.groupBy(*PAIR, "user_id").agg(*total, F.sum(one).alias("unique_sessions"))
    found = of_user.groupBy(*PAIR).agg(*total, F.count("user_id").alias("unique_users"), F.sum("unique_sessions").alias("unique_sessions"))
    return named_window(found, start, end)


def weighted_window_sums(counts: DataFrame, start: str, end: str, time_decay: TimeDecay = TimeDecay()) -> DataFrame:
    """Sums of daily counts over a window, weighted ones by age."""
    weight = time_decay.weight(_age(end))
    return within_window(with_weighted_counts(counts), start, end).groupBy(*PAIR).agg(*(F.sum(c).alias(c) for c in RAW_COUNTS), *(F.sum(F.col(c) * weight).alias(c) for c in WEIGHTED_COUNTS))


def aggregate_window_from_daily(counts: DataFrame, user_keys: DataFrame, session_keys: DataFrame, start: str, end: str, time_decay: TimeDecay = TimeDecay(), item_bucket: tuple[int, int] | None = None) -> DataFrame:
    """From the compact daily tables; the same result as from raw pairs. ``item_bucket`` is (id, count)."""
    if item_bucket is not None:
        b, n = item_bucket
        if n < 1 or not 0 <= b < n:
            raise ValueError("the bucket must be between 0 and the number of buckets")
        counts, user_keys, session_keys = (df.filter(F.pmod("item_id", F.lit(n)) == b) for df in (counts, user_keys, session_keys))
    sums = weighted_window_sums(counts, start, end, time_decay)
    users = within_window(user_keys, start, end).select(*PAIR, "user_id").distinct().groupBy(*PAIR).agg(F.count("*").alias("unique_users"))
    sessions = within_window(session_keys, start, end).select(*PAIR, "user_id", "session_index").distinct().groupBy(*PAIR).agg(F.count("*").alias("unique_sessions"))
    joined = sums.join(users, [*PAIR], "left").join(sessions, [*PAIR], "left").fillna(0, ["unique_users", "unique_sessions"])
    return named_window(joined, start, end)
