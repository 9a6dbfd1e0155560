"""Event cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.schemas import ACTIONS, CONTRACTS, require_columns


def readable_events(raw: DataFrame, actions: Sequence[str] = ACTIONS, *more: str) -> DataFrame:
    """The cleaning of single rows, which a stream can do too: rows with all keys, one of the actions and a readable timestamp."""
    require_columns(raw, "raw_events")
    kept = raw.select(*CONTRACTS["raw_events"], *more).filter(F.col("user_id").isNotNull() & F.col("item_id").isNotNull() & F.col("action_type").isin(*actions))
    return kept.withColumn("timestamp", _parsed(kept)).filter("timestamp IS NOT NULL")


def _parsed(events: DataFrame) -> Column:
    text = dict(events.dtypes)["timestamp"] == "string"
    return F.try_to_timestamp("timestamp").cast("timestamp_ntz") if text else F.col("timestamp").try_cast("timestamp_ntz")


def clean_events(raw: DataFrame, actions: Sequence[str] = ACTIONS) -> DataFrame:
    """Raw events without exact copies, rows with missing keys or other actions.

    The event date comes from the timestamp, not from the partition; unreadable timestamps count as missing. What needs
    no comparison of rows is filtered first, so the duplicate removal shuffles item events alone.
    """
    require_columns(raw, "raw_events")
    events = raw.select(*CONTRACTS["raw_events"]).filter(F.col("user_id").isNotNull() & F.col("item_id").isNotNull() & F.col("action_type").isin(*actions) & F.col("timestamp").isNotNull()).dropDuplicates()
    return events.withColumn("timestamp", _parsed(events)).filter("timestamp IS NOT NULL").select(
        "user_id", F.to_date("timestamp").alias("event_date"), "timestamp", "action_type", "item_id", "search_query", F.coalesce(F.col("widget_name").cast("string"), F.lit("unknown")).alias("widget_name")
    )
