"""Directed item pairs of sessions, and the compact daily tables of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions.decay import DistanceDecay, WidgetContext
from pairloom.operators.placing import placed_in_ranges
from pairloom.schemas import ACTIONS, require_columns
from pairloom.sources.files import staged

MAX_ITEMS = 50
PAIR = "item_id", "similar_item_id"


@dataclass(frozen=True)
class PairSettings:
    max_items_per_session: int = MAX_ITEMS
    actions: Sequence[str] = ACTIONS
    signal_priority: Mapping[str, int] | None = None
    distance_decay: DistanceDecay = DistanceDecay()
    widget_context: WidgetContext = WidgetContext()

    def __post_init__(self) -> None:
        if self.max_items_per_session < 2:
            raise ValueError("max_items_per_session must be at least 2")

    def priority(self, action: Column) -> Column:
        """The configured priority, else the place among the actions; 0 for others."""
        ranks = self.signal_priority or {a: k for k, a in enumerate(self.actions, 1)}
        chain = F.lit(0)
        for a, p in ranks.items():
            chain = F.when(action == a, F.lit(int(p))).otherwise(chain)
        return chain


def _heavy_sessions(events: DataFrame, settings: PairSettings, least: int) -> DataFrame | None:
    """(user_id, session_index, _fits): sessions of ``least`` events or more, and whether they have an allowed number of items; None if there are none."""
    by_item = events.groupBy("user_id", "session_index", "item_id").agg(F.count("*").alias("_n"))
    sizes = by_item.groupBy("user_id", "session_index").agg(F.sum("_n").alias("_n"), F.count("*").alias("_items")).filter(F.col("_n") >= least)
    heavy = staged(sizes.select("user_id", "session_index", F.col("_items").between(2, settings.max_items_per_session).alias("_fits")))
    return None if heavy.isEmpty() else heavy


def session_items(sessions: DataFrame, settings: PairSettings = PairSettings(), heavy_events: int | None = None) -> DataFrame:
    """One row for each item of a session: its strongest action, that action's widget, and its first position.

    Equal priorities go to the earlier event, then to the smaller widget and action name. Sessions with fewer than two
    or more than the allowed items are left out. Sessions are dealt by user and session, so a user with very many of them is
    no task's alone. With ``heavy_events``, a session of as many events or more isn't either: it is left out by partial
    counts of its items before anything is ordered, or else its events are placed in ranges.
    """
    require_columns(sessions, "sessions")
    session = ["user_id", "session_index"]
    events, order = sessions.filter(F.col("action_type").isin(*settings.actions) & F.col("item_id").isNotNull()), ["timestamp", "item_id", "action_type", "widget_name"]
    number = F.row_number().over(Window.partitionBy(*session).orderBy(*order))
    heavy = _heavy_sessions(events, settings, heavy_events) if heavy_events else None
    if heavy is None:
        placed = events.repartition(*session).withColumn("_position", number)
    else:
        light = events.join(heavy.select(*session), session, "left_anti").repartition(*session).withColumn("_position", number)
        long = events.join(heavy.filter("_fits").select(*session), session, "left_semi")
        placed = light.unionByName(placed_in_ranges(long, session, order, "_position"))
    placed = placed.withColumn("_priority", settings.priority(F.col("action_type")))
    strongest = F.struct("_priority", (-F.col("_position")).alias("_earlier"))
    items = placed.groupBy(*session, "session_start_date", "item_id").agg(
        F.max_by("action_type", strongest).alias("item_action_type"), F.max_by("widget_name", strongest).alias("item_widget_name"), F.max("_priority").alias("signal_priority"), F.min("_position").alias("event_position")
    )
    n = F.count("*").over(Window.partitionBy(*session))
    return items.withColumn("_n", n).filter(F.col("_n").between(2, settings.max_items_per_session)).drop("_n")


@dataclass(frozen=True)
class Support:
    """Sessions and users that an item needs, as pairs that have fewer are of no use to a scorer."""

    sessions: int = 1
    users: int = 1

    @property
    def prunes(self) -> bool:
        return self.sessions > 1 or self.users > 1


def supported_items(items: DataFrame, support: Support) -> DataFrame:
    """Session items without those that are in too few sessions or have too few users.

    A pair's sessions and users are some of either item's, and it has a row a session at most, so only pairs that would
    not reach the numbers are lost, and all others stay as they are: positions and sizes of sessions were taken before.
    Items are counted by user first, so a popular one is no task's alone; they are written, as they are read twice.
    """
    items = staged(items)
    by_user = items.groupBy("item_id", "user_id").agg(F.count("*").alias("_n"))
    enough = by_user.groupBy("item_id").agg(F.sum("_n").alias("_sessions"), F.count("*").alias("_users")).filter((F.col("_sessions") >= support.sessions) & (F.col("_users") >= support.users))
    return items.join(enough.select("item_id"), "item_id", "left_semi")


def item_pairs(sessions: DataFrame, settings: PairSettings = PairSettings(), support: Support = Support(), heavy_events: int | None = None) -> DataFrame:
    """Both directions of all pairs of a session's items, with weights.

    A session's items, a bounded number, meet as an array and are exploded twice where they are: no self-join. With
    ``support``, counted over these sessions, only pairs of items that have it.
    """
    items = session_items(sessions, settings, heavy_events)
    if support.prunes:
        items = supported_items(items, support)
    one = F.struct("item_id", "item_action_type", "item_widget_name", "event_position").alias("i")
    sets = items.groupBy("user_id", "session_index", "session_start_date").agg(F.collect_list(one).alias("items"))
    both = sets.withColumn("s", F.explode("items")).withColumn("t", F.explode("items")).filter("s.item_id <> t.item_id")
    distance = F.abs(F.col("t.event_position") - F.col("s.event_position"))
    pairs = both.select(
        F.col("session_start_date").alias("pair_date"), F.col("s.item_id").alias("item_id"), F.col("t.item_id").alias("similar_item_id"), "user_id", "session_index",
        F.col("s.item_action_type").alias("source_action_type"), F.col("t.item_action_type").alias("target_action_type"), F.col("s.item_widget_name").alias("source_widget_name"), F.col("t.item_widget_name").alias("target_widget_name"),
        F.col("t.item_action_type").alias("signal_type"), F.col("s.event_position").cast("long").alias("source_event_position"), F.col("t.event_position").cast("long").alias("target_event_position"), distance.cast("long").alias("position_distance"),
    )
    if settings.distance_decay.enabled and settings.distance_decay.max_distance is not None:
        pairs = pairs.filter(F.col("position_distance") <= settings.distance_decay.max_distance)
    weighed = pairs.withColumn("distance_weight", settings.distance_decay.weight(F.col("position_distance"))).withColumn("widget_weight", settings.widget_context.of_pair())
    return weighed.withColumn("graph_weight", F.col("distance_weight") * F.col("widget_weight"))


def with_graph_weight(pairs: DataFrame) -> DataFrame:
    """Pairs from elsewhere: missing weights count as 1, a missing product is made."""
    for c in ("distance_weight", "widget_weight"):
        if c not in pairs.columns:
            pairs = pairs.withColumn(c, F.lit(1.0))
    return pairs if "graph_weight" in pairs.columns else pairs.withColumn("graph_weight", F.col("distance_weight") * F.col("widget_weight"))


def count_columns(weight: Column) -> list[Column]:
    """Raw and weighted counts of pairs, in all and by signal."""
    raw = [F.count("*").alias("pair_count"), *(F.count_if(F.col("signal_type") == a).alias(f"{a}_count") for a in ACTIONS)]
    weighted = [F.sum(weight).alias("weighted_pair_count"), *(F.sum(F.when(F.col("signal_type") == a, weight).otherwise(0.0)).alias(f"weighted_{a}_count") for a in ACTIONS)]
    return [*raw, *weighted]


def pair_counts(pairs: DataFrame) -> DataFrame:
    return with_graph_weight(pairs).groupBy("pair_date", *PAIR).agg(*count_columns(F.col("graph_weight")))


def pair_widget_counts(pairs: DataFrame) -> DataFrame:
    return with_graph_weight(pairs).groupBy("pair_date", *PAIR, "target_widget_name").agg(*count_columns(F.col("graph_weight")))


def pair_user_keys(pairs: DataFrame) -> DataFrame:
    return pairs.select("pair_date", *PAIR, "user_id").distinct()


def pair_session_keys(pairs: DataFrame) -> DataFrame:
    return pairs.select("pair_date", *PAIR, "user_id", "session_index").distinct()


def raw_pair_rows(pairs: DataFrame) -> DataFrame:
    """How many raw pairs each day has."""
    return pairs.groupBy("pair_date").agg(F.count("*").alias("raw_pair_rows"))


@dataclass(frozen=True)
class DailyPairStats:
    counts: DataFrame
    widget_counts: DataFrame
    user_keys: DataFrame
    session_keys: DataFrame


def daily_pair_stats(sessions: DataFrame, settings: PairSettings = PairSettings()) -> DailyPairStats:
    """The four compact daily tables; they add up over days and users, so days can be built one by one."""
    return stats_of_pairs(item_pairs(sessions, settings))


def stats_of_pairs(pairs: DataFrame) -> DailyPairStats:
    """The tables of pairs, which are read once for each of them."""
    return DailyPairStats(pair_counts(pairs), pair_widget_counts(pairs), pair_user_keys(pairs), pair_session_keys(pairs))
