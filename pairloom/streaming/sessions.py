"""Sessions of an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.schemas import ACTIONS


def session_windows(events: DataFrame, timeout_minutes: int = 30, lateness: str = "1 hour", actions: tuple[str, ...] = ACTIONS) -> DataFrame:
    """Finished sessions of a stream of clean events: user, start, end, events, distinct items.

    A gap of exactly the timeout goes on, as in batch, where gaps count in whole seconds: the window's gap is just under
    a second longer. Events later than ``lateness`` are dropped with the state they would need.
    """
    stamped = events.filter(F.col("action_type").isin(*actions) & F.col("item_id").isNotNull()).withColumn("_ts", F.col("timestamp").cast("timestamp")).withWatermark("_ts", lateness)
    gap = F.session_window("_ts", f"{timeout_minutes * 60} seconds 999999 microseconds")
    found = stamped.groupBy("user_id", gap.alias("w")).agg(F.min("_ts").alias("session_start"), F.max("_ts").alias("session_end"), F.count("*").alias("events"), F.collect_set("item_id").alias("items"))
    return found.drop("w")
