"""Column contracts. Tables may have further columns; names are checked, order and types are not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ACTIONS = ("view", "click", "favorite", "to_cart")
RAW_COUNTS = ("pair_count", "view_count", "click_count", "favorite_count", "to_cart_count")
WEIGHTED_COUNTS = tuple(f"weighted_{c}" for c in RAW_COUNTS)
_PAIR = ("item_id", "similar_item_id")

# The names that tables must have.
CONTRACTS: dict[str, tuple[str, ...]] = {
    "raw_events": ("user_id", "date", "timestamp", "action_type", "widget_name", "search_query", "item_id"),
    "product_information": ("item_id", "name", "brand", "type", "category_id", "category_name"),
    "clean_events": ("user_id", "event_date", "timestamp", "action_type", "item_id", "search_query", "widget_name"),
    "sessions": ("user_id", "session_index", "session_start_date", "event_date", "timestamp", "action_type", "item_id", "widget_name"),
    "item_popularity": ("item_id", "events_count", "unique_users", "views_count", "clicks_count", "favorites_count", "to_cart_count"),
    "action_type_distribution": ("action_type", "events_count", "event_share", "unique_users", "unique_items", "calibration_start", "calibration_end"),
    "daily_item_pairs": ("pair_date", *_PAIR, "user_id", "session_index", "source_action_type", "target_action_type", "source_widget_name", "target_widget_name", "signal_type"),
    "daily_pair_counts": ("pair_date", *_PAIR, *RAW_COUNTS, *WEIGHTED_COUNTS),
    "daily_pair_widget_counts": ("pair_date", *_PAIR, "target_widget_name", *RAW_COUNTS, *WEIGHTED_COUNTS),
    "daily_pair_user_keys": ("pair_date", *_PAIR, "user_id"),
    "daily_pair_session_keys": ("pair_date", *_PAIR, "user_id", "session_index"),
    "pair_aggregates": (*_PAIR, *RAW_COUNTS, *WEIGHTED_COUNTS, "unique_users", "unique_sessions", "window_start", "window_end"),
    "pair_scores": (*_PAIR, "score", *RAW_COUNTS, *WEIGHTED_COUNTS, "unique_users", "unique_sessions"),
    "recommendations": (*_PAIR, "score", "rank", "source"),
    "widget_output": ("item_id", "similar_items_sku_list"),
    "ground_truth": ("item_id", "relevant_item_id", "relevance", "target_action_type", "evidence_count", "view_count", "click_count", "favorite_count", "to_cart_count"),
    "enriched": ("item_id", "item_name", "similar_item_id", "similar_item_name", "rank", "score", "source"),
}

_TYPES: dict[str, T.DataType] = (
    dict.fromkeys(("date", "event_date", "session_start_date", "pair_date"), T.DateType())
    | {"timestamp": T.TimestampNTZType(), "rank": T.LongType(), "similar_items_sku_list": T.ArrayType(T.LongType())}
    | dict.fromkeys((*WEIGHTED_COUNTS, "score", "event_share", "relevance"), T.DoubleType())
    | dict.fromkeys(
        ("action_type", "widget_name", "search_query", "name", "brand", "type", "category_name", "source", "signal_type", "source_action_type", "target_action_type", "source_widget_name", "target_widget_name", "window_start", "window_end", "calibration_start", "calibration_end", "item_name", "similar_item_name"),
        T.StringType(),
    )
)


def schema(contract: str) -> T.StructType:
    """Spark schema of a contract; ids and counts are longs."""
    return T.StructType([T.StructField(c, _TYPES.get(c, T.LongType())) for c in CONTRACTS[contract]])


def empty(spark: SparkSession, contract: str) -> DataFrame:
    return spark.createDataFrame([], schema(contract))


def require_columns(df: DataFrame, contract: str) -> DataFrame:
    """``df`` itself; raises ValueError if it lacks columns of the contract."""
    if missing := sorted(set(CONTRACTS[contract]) - set(df.columns)):
        raise ValueError(f"{contract} is missing expected columns: {missing}")
    return df
