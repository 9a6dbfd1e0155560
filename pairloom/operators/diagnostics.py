"""Profiles of tables and session gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.popularity import counted_with_distinct
from pairloom.operators.sessions import seconds_between

QUANTILES = (0.5, 0.75, 0.9, 0.95, 0.99)


def schema_overview(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, dtype string")


def null_profile(df: DataFrame) -> DataFrame:
    """Rows, nulls and their share (null for an empty table) of each column, from one pass."""
    names = df.columns
    one = df.agg(F.count("*").alias("row_count"), *(F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{k}") for k, c in enumerate(names)))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"_{k}").alias("null_count")) for k, c in enumerate(names))))
    return one.select("row_count", each.alias("c")).select("c.column_name", "row_count", "c.null_count", F.try_divide("c.null_count", "row_count").alias("null_share"))


def action_profile(events: DataFrame) -> DataFrame:
    """Rows, users, items and missing values of each action."""
    sums = [F.count("*").alias("rows"), F.count_if(F.col("item_id").isNull()).alias("missing_items"), F.count_if(F.col("widget_name").isNull()).alias("missing_widgets")]
    found = counted_with_distinct(events, "action_type", {"user_id": "unique_users", "item_id": "unique_items"}, sums)
    return found.withColumns({"missing_item_share": F.col("missing_items") / F.col("rows"), "missing_widget_share": F.col("missing_widgets") / F.col("rows"), "row_share": F.col("rows") / F.sum("rows").over(Window.partitionBy())})


def partition_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Files, rows and bytes of each partition of a file source."""
    files = df.select(*keys, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).groupBy(*keys, "file").agg(F.count("*").alias("rows"), F.max("size").alias("size"))
    return files.groupBy(*keys).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("size").alias("bytes"))


def session_markers(events: DataFrame, timeout_minutes: float = 30, user: str = "user_id", timestamp: str = "timestamp", by: Sequence[str] = ()) -> DataFrame:
    """Adds the seconds since the user's last event, and whether a session starts."""
    w = Window.partitionBy(*by, user).orderBy(timestamp)
    gap = seconds_between(F.lag(timestamp).over(w), F.col(timestamp))
    return events.withColumn("time_diff_seconds", gap).withColumn("is_new_session", F.when(F.col("time_diff_seconds").isNull() | (F.col("time_diff_seconds") > timeout_minutes * 60), 1).otherwise(0))


def gap_summary(events: DataFrame, timeout_minutes: float = 30, by: Sequence[str] = (), quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Counts and linear quantiles of gaps; markers start anew in each key of ``by``.

    Gaps are whole seconds: they are counted by value first, so what meets in the end is distinct values alone.
    """
    d, n = F.col("time_diff_seconds"), F.col("_n")
    counted = session_markers(events, timeout_minutes, by=by).groupBy(*by, d).agg(F.count("*").alias("_n"), F.sum("is_new_session").alias("_new"))
    of = lambda test, name: F.coalesce(F.sum(F.when(test, n)), F.lit(0)).alias(name)
    return counted.groupBy(*by).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("events"), of(d.isNotNull(), "diffs"), of(d < 0, "negative"), of(d == 0, "zero"), of(d > timeout_minutes * 60, "over_timeout"), F.coalesce(F.sum("_new"), F.lit(0)).alias("sessions"),
        *(F.percentile(d, F.lit(q), n).alias(f"p{round(100 * q)}") for q in quantiles),
    )
