"""Sessions: runs of a user's events without a gap beyond the timeout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.schemas import CONTRACTS, require_columns
from pairloom.sources.files import staged

TIMEOUT_MINUTES = 30
#: Events from which on a user's rows are ordered by day instead of all at once.
HEAVY_EVENTS = 1_000_000
ORDER = "timestamp", "item_id", "action_type"


def _item_events(clean: DataFrame) -> DataFrame:
    require_columns(clean, "clean_events")
    return clean.select("user_id", "event_date", "timestamp", "action_type", "item_id", "widget_name").filter("user_id IS NOT NULL AND timestamp IS NOT NULL AND item_id IS NOT NULL")


def seconds_between(earlier: Column, later: Column) -> Column:
    """Whole seconds of the difference."""
    return F.timestamp_diff("SECOND", earlier, later)


def _starts(previous: Column, timeout_minutes: float) -> Column:
    """1 where a session starts: no event before, or a gap longer than the timeout; an equal one goes on."""
    gap = seconds_between(previous, F.col("timestamp"))
    return F.when(gap.isNull() | (gap > timeout_minutes * 60), 1).otherwise(0)


def build_sessions(clean: DataFrame, timeout_minutes: float = TIMEOUT_MINUTES) -> DataFrame:
    """Clean events with session_index (from 1 in each user) and session_start_date; one shuffle, by user."""
    if timeout_minutes <= 0:
        raise ValueError("timeout_minutes must be positive")
    by_user = Window.partitionBy("user_id").orderBy(*ORDER)
    marked = _item_events(clean).withColumn("_new", _starts(F.lag("timestamp").over(by_user), timeout_minutes))
    indexed = marked.withColumn("session_index", F.sum("_new").over(by_user.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.min("event_date").over(Window.partitionBy("user_id", "session_index"))
    return indexed.withColumn("session_start_date", start).select(*CONTRACTS["sessions"])


def build_sessions_by_day(clean: DataFrame, timeout_minutes: float = TIMEOUT_MINUTES) -> DataFrame:
    """The same sessions for logs in which single users have a large part of all events.

    Rows are ordered within a user's day only. What goes over midnight, the last event before a day and the sessions
    begun before it, comes from sums with one row for each user and day.
    """
    if timeout_minutes <= 0:
        raise ValueError("timeout_minutes must be positive")
    events, day = _item_events(clean), ["user_id", "event_date"]
    within, days = Window.partitionBy(*day).orderBy(*ORDER), Window.partitionBy("user_id").orderBy("event_date")
    ends = events.groupBy(*day).agg(F.max("timestamp").alias("_last")).withColumn("_before", F.lag("_last").over(days)).drop("_last")
    marked = events.join(ends, day).withColumn("_new", _starts(F.coalesce(F.lag("timestamp").over(within), "_before"), timeout_minutes))
    begun = marked.groupBy(*day).agg(F.sum("_new").alias("_n"), F.max("_new").alias("_any"))
    begun = begun.withColumn("_base", F.coalesce(F.sum("_n").over(days.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    begun = begun.withColumn("_began", F.last(F.when(F.col("_any") > 0, F.col("event_date")), ignorenulls=True).over(days.rowsBetween(Window.unboundedPreceding, -1))).select(*day, "_base", "_began")
    so_far = F.sum("_new").over(within.rowsBetween(Window.unboundedPreceding, 0))
    indexed = marked.join(begun, day).withColumn("_so_far", so_far)
    return indexed.withColumn("session_index", F.col("_base") + F.col("_so_far")).withColumn("session_start_date", F.when(F.col("_so_far") > 0, F.col("event_date")).otherwise(F.col("_began"))).select(*CONTRACTS["sessions"])


def build_sessions_of_all(clean: DataFrame, timeout_minutes: float = TIMEOUT_MINUTES, heavy_events: int = HEAVY_EVENTS) -> DataFrame:
    """The same sessions whoever has most of the events: users of ``heavy_events`` or more by day, all others at once.

    Counts are partial sums by user. The heavy users are at most all events over ``heavy_events``, so Spark may broadcast
    them by their true size; the two parts of the events are never shuffled for being told apart where it does.
    """
    heavy = clean.groupBy("user_id").agg(F.count("*").alias("_n")).filter(F.col("_n") >= heavy_events).select("user_id")
    heavy = staged(heavy)
    if heavy.isEmpty():
        return build_sessions(clean, timeout_minutes)
    light = build_sessions(clean.join(heavy, "user_id", "left_anti"), timeout_minutes)
    return light.unionByName(build_sessions_by_day(clean.join(heavy, "user_id", "left_semi"), timeout_minutes))
