"""Exact distinct users of pairs by sets of dense codes, bitmaps where they are full.

Users get codes without gaps. A pair's users of a day are kept by buckets of 32768 codes: a bucket of few users as the list
of its codes, one of many as a bitmap of 4 KiB. Lists and bitmaps of any days merge exactly (lists of a bucket that is a
bitmap somewhere become one too), so windows read a row for each pair, day and bucket instead of one for each user.
A session belongs to the one date that it starts on, so numbers of sessions just add up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.decay import TimeDecay
from pairloom.operators.aggregate import named_window, weighted_window_sums, within_window
from pairloom.operators.pairs import PAIR, DailyPairStats
from pairloom.sources.files import staged

#: Codes of a bucket from which on it is a bitmap: as many bytes as a list of so many codes.
FULL = 1024
_BUCKET = [*PAIR, "bucket"]


@dataclass(frozen=True)
class DailySets:
    """Daily counts, numbers of sessions, and users as sets of codes."""

    counts: DataFrame
    sessions: DataFrame
    users: DataFrame


def user_codes(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(user_id, code): codes from 0 without gaps, after those of ``known``, which stay.

    Users are ranked within ranges and ranges by their sizes, so no task sees all of them.
    """
    new = users.select("user_id").filter("user_id IS NOT NULL").distinct()
    first = 0
    if known is not None:
        new = new.join(known, "user_id", "left_anti")
        first = (known.agg(F.max("code")).first()[0] or -1) + 1
    dealt = staged(new.repartitionByRange("user_id").withColumn("part", F.spark_partition_id()))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("before"))  # a row for each range
    ranked = dealt.withColumn("n", F.row_number().over(Window.partitionBy("part").orderBy("user_id")))
    coded = ranked.join(F.broadcast(sizes), "part").select("user_id", (F.col("before") + F.col("n") - 1 + first).cast("long").alias("code"))
    return coded if known is None else known.select("user_id", "code").unionByName(coded)


def _as_bitmaps(codes: DataFrame, *keys: str) -> DataFrame:
    return codes.groupBy(*keys).agg(F.bitmap_construct_agg("code").alias("bits"))


def daily_sets(daily: DailyPairStats, codes: DataFrame, full: int = FULL) -> DailySets:
    """The compact daily tables with key tables as sets."""
    day = ["pair_date", *_BUCKET]
    coded = daily.user_keys.join(codes, "user_id").select("pair_date", *PAIR, F.bitmap_bucket_number("code").alias("bucket"), F.bitmap_bit_position("code").cast("int").alias("code"))
    lists = coded.groupBy(*day).agg(F.collect_list("code").alias("codes"))  # 32768 at most
    few = lists.filter(F.size("codes") < full).withColumn("bits", F.lit(None).cast("binary"))
    many = _as_bitmaps(lists.filter(F.size("codes") >= full).withColumn("code", F.explode("codes")), *day).withColumn("codes", F.lit(None).cast("array<int>"))
    sessions = daily.session_keys.groupBy("pair_date", *PAIR).agg(F.count("*").alias("sessions"))
    return DailySets(daily.counts, sessions, few.unionByName(many))


def unique_users(sets: DataFrame) -> DataFrame:
    """(item_id, similar_item_id, unique_users) of the days of ``sets``."""
    bitmaps = sets.filter("bits IS NOT NULL").select(*_BUCKET, "bits")
    codes = sets.filter("codes IS NOT NULL").select(*_BUCKET, F.explode("codes").alias("code"))
    somewhere = bitmaps.select(*_BUCKET).distinct()
    full = bitmaps.unionByName(_as_bitmaps(codes.join(somewhere, _BUCKET, "left_semi"), *_BUCKET)).groupBy(*_BUCKET).agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    few = codes.join(somewhere, _BUCKET, "left_anti").distinct().groupBy(*_BUCKET).agg(F.count("*").alias("n"))
    return full.unionByName(few).groupBy(*PAIR).agg(F.sum("n").alias("unique_users"))


def aggregate_window_from_sets(sets: DailySets, start: str, end: str, time_decay: TimeDecay = TimeDecay()) -> DataFrame:
    """The window's pair aggregates; the same as from raw pairs."""
    users = unique_users(within_window(sets.users, start, end))
    sessions = within_window(sets.sessions, start, end).groupBy(*PAIR).agg(F.sum("sessions").alias("unique_sessions"))
    sums = weighted_window_sums(sets.counts, start, end, time_decay)
    return named_window(sums.join(users, [*PAIR], "left").join(sessions, [*PAIR], "left").fillna(0, ["unique_users", "unique_sessions"]), start, end)
