"""Tables in buckets, so that steps over the same key share one shuffle.

Clean events in buckets of users are shuffled once, while they are cleaned: exact copies have the same user. Sessions, their
items and the users of each item then take no further shuffle by user. Pair aggregates in buckets of items give scores
and ranked lists without any, for as many parameter sets as are tried. A bucketed table lies at a path of its own;
another session registers it again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from pairloom.operators.cleaning import clean_events
from pairloom.schemas import ACTIONS

USER_BUCKETS, ITEM_BUCKETS = 256, 128


def write_buckets(df: DataFrame, name: str, path: str, key: str, buckets: int, order: Sequence[str] = ()) -> DataFrame:
    """``df`` as a table of one file for each bucket of ``key``, sorted by it and ``order``."""
    df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key, *order).saveAsTable(name)
    return df.sparkSession.table(name)


def open_buckets(spark: SparkSession, name: str, path: str, key: str, buckets: int, order: Sequence[str] = ()) -> DataFrame:
    """A table that ``write_buckets`` made in another session."""
    columns = ", ".join(f"`{c}` {kind}" for c, kind in spark.read.parquet(path).dtypes)
    by = ", ".join(f"`{c}`" for c in (key, *order))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def clean_in_buckets(raw: DataFrame, name: str, path: str, buckets: int = USER_BUCKETS, actions: Sequence[str] = ACTIONS) -> DataFrame:
    """Clean events in buckets of users: one shuffle for cleaning and layout."""
    return write_buckets(clean_events(raw.repartition(buckets, "user_id"), actions), name, path, "user_id", buckets, ("timestamp", "item_id", "action_type"))


def aggregates_in_buckets(aggregates: DataFrame, name: str, path: str, buckets: int = ITEM_BUCKETS) -> DataFrame:
    """Pair aggregates in buckets of items."""
    return write_buckets(aggregates, name, path, "item_id", buckets, ("similar_item_id",))
