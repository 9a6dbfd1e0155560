"""Detailed, enriched and compact outputs, and their manifests."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.fallback import catalogue
from pairloom.schemas import CONTRACTS, require_columns
from pairloom.sources.files import joined, write_text


#: Bytes of a row group of look-up lists, and the file that has their ranges; names with an underscore are no data to Spark.
ROW_GROUP_BYTES = 4 << 20
RANGES = "_ranges.json"


def enriched(recommendations: DataFrame, products: DataFrame) -> DataFrame:
    """Recommendations with the names of both items."""
    names = catalogue(products)
    mine, similar = names.select("item_id", F.col("name").alias("item_name")), names.select(F.col("item_id").alias("similar_item_id"), F.col("name").alias("similar_item_name"))
    return recommendations.join(mine, "item_id", "left").join(similar, "similar_item_id", "left").select(*CONTRACTS["enriched"])


def lookup_lists(recommendations: DataFrame) -> DataFrame:
    """One array of similar items for each item, by rank and then id; a list has top_k entries at most."""
    rows = require_columns(recommendations, "recommendations").filter("item_id IS NOT NULL AND similar_item_id IS NOT NULL AND rank IS NOT NULL")
    placed = rows.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("rank", "similar_item_id"))).alias("_placed"))
    return placed.select("item_id", F.transform("_placed", lambda p: p["similar_item_id"]).alias("similar_items_sku_list"))


def combined(first: DataFrame, *more: DataFrame) -> DataFrame:
    """All rows, by names of columns; a column that a table lacks is null in its rows."""
    for df in more:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def write_detailed(recommendations: DataFrame, path: str) -> None:
    require_columns(recommendations, "recommendations").write.mode("overwrite").parquet(path)


def write_enriched(recommendations: DataFrame, products: DataFrame, path: str) -> None:
    enriched(recommendations, products).sort("item_id", "rank", "similar_item_id").write.mode("overwrite").parquet(path)


def write_lookup(recommendations: DataFrame, path: str, files: int | None = None) -> None:
    """Lists dealt by ranges of items and sorted, for look-ups of single items; as many files as Spark finds right, or as told.

    A file of ranges beside the data says which file has an item; in it, small row groups with bounds and a bloom filter
    leave one to be read.
    """
    lists = lookup_lists(recommendations)
    lists = lists.repartitionByRange(*([files] if files else []), "item_id").sortWithinPartitions("item_id")
    lists.write.mode("overwrite").option("parquet.bloom.filter.enabled#item_id", "true").option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)
    ids = recommendations.sparkSession.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("item_id").alias("first"), F.max("item_id").alias("last"))
    write_manifest(joined(path, RANGES), {"files": [r.asDict() for r in ids.orderBy("first").collect()]})  # a row for each file


def write_daily(df: DataFrame, path: str, date_column: str = "pair_date") -> None:
    """One partition a day; days that the table has are replaced, others stay.

    Rows are dealt by day, small days together and large ones split by Spark, so files follow the size, not the number of
    shuffle partitions times that of days.
    """
    df.hint("rebalance", date_column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_column).parquet(path)


def write_preview(recommendations: DataFrame, folder: str) -> None:
    """A preview as CSV and JSON."""
    recommendations.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/preview_csv")
    recommendations.coalesce(1).write.mode("overwrite").json(f"{folder}/preview_json")


def write_manifest(path: str, values: Mapping[str, Any]) -> None:
    """JSON from the driver, to any store; readers see a whole one."""
    write_text(path, json.dumps(values, indent=2, sort_keys=True, default=str))


def publish_latest(run_dir: str, latest_dir: str, rows: int, allow_empty: bool = False) -> bool:
    """Point ``latest`` at a run's outputs, unless they are empty; whether it was done.

    The pointer is a manifest that is replaced as a whole: a reader finds the last run or this one, never a part.
    """
    if not rows and not allow_empty:
        return False
    write_manifest(joined(latest_dir, "manifest.json"), {"run_dir": run_dir, "rows": rows, "lookup_path": joined(run_dir, "lookup.parquet"), "detailed_path": joined(run_dir, "detailed.parquet")})
    return True
