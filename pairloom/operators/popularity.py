"""Item popularity and the distribution of actions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.schemas import ACTIONS

_COUNTED = {"view": "views_count", "click": "clicks_count", "favorite": "favorites_count", "to_cart": "to_cart_count"}


def item_events(clean: DataFrame, actions: Sequence[str] = ACTIONS) -> DataFrame:
    return clean.filter(F.col("item_id").isNotNull() & F.col("action_type").isin(*actions))


def counted_with_distinct(df: DataFrame, key: str, distinct: Mapping[str, str], sums: Sequence[Column]) -> DataFrame:
    """Sums by a key, and the distinct values of several columns, each counted by itself.

    Counted together, every row would be shuffled once for each column; apart, tasks reduce rows to distinct values first,
    and what is joined is a row for each key.
    """
    found = df.groupBy(key).agg(*sums)
    for column, name in distinct.items():
        values = df.select(F.col(key).alias("_key"), column).distinct().groupBy("_key").agg(F.count(column).alias(name))
        found = found.join(values, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    return found


def item_popularity(clean: DataFrame, by: Sequence[str] = (), actions: Sequence[str] = ACTIONS) -> DataFrame:
    """Events, users and events by action of each item, and of each further key in ``by``."""
    counts = [] if "action_type" in by else [F.count_if(F.col("action_type") == a).alias(c) for a, c in _COUNTED.items()]
    return item_events(clean, actions).groupBy(*by, "item_id").agg(F.count("*").alias("events_count"), F.count_distinct("user_id").alias("unique_users"), *counts)


def action_distribution(clean: DataFrame, start: str, end: str, actions: Sequence[str] = ACTIONS) -> DataFrame:
    """Share of all events, users and items of each action; at most as many rows as actions."""
    found = counted_with_distinct(item_events(clean, actions), "action_type", {"user_id": "unique_users", "item_id": "unique_items"}, [F.count("*").alias("events_count")])
    share = F.col("events_count") / F.sum("events_count").over(Window.partitionBy())
    return found.select("action_type", "events_count", share.alias("event_share"), "unique_users", "unique_items", F.lit(start).alias("calibration_start"), F.lit(end).alias("calibration_end"))


def action_shares(distribution: DataFrame) -> dict[str, float]:
    """The shares as a mapping for the scorer."""
    return {r["action_type"]: r["event_share"] for r in distribution.select("action_type", "event_share").collect()}
