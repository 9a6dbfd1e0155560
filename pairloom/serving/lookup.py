"""Look-up of similar items in written lists."""

from __future__ import annotations

import json
from bisect import bisect_right
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.output.writers import RANGES
from pairloom.sources.files import exists, joined, read_text


class SimilarItems:
    """Lists at a Parquet path, a folder that has ``lookup.parquet`` or a manifest, or a manifest that names one; in any store."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, self._resolve(path)
        self._lists = spark.read.parquet(self._path)
        ranges = joined(self._path, RANGES)
        self._files = json.loads(read_text(ranges))["files"] if exists(ranges) else None

    @staticmethod
    def _resolve(path: str) -> str:
        manifest = path if path.endswith(".json") else joined(path, "manifest.json")
        if not path.endswith(".json"):
            if exists(joined(path, "lookup.parquet")):
                return joined(path, "lookup.parquet")
            if not exists(manifest):
                return path
        named = json.loads(read_text(manifest))
        target = next((named[k] for k in ("lookup_path", "lookup", "widget_output_path") if named.get(k)), None)
        if target is None:
            raise ValueError(f"{path} names no look-up table")
        return target if "://" in target or target.startswith("/") else joined(manifest.rpartition("/")[0] or ".", target)

    def of(self, item_id: Any) -> DataFrame | None:
        """The row of an item: where ranges are known, from the one file that may have it; None if none may."""
        lists = self._lists
        if self._files is not None:
            at = bisect_right(self._files, item_id, key=lambda f: f["first"]) - 1
            if at < 0 or self._files[at]["last"] < item_id:
                return None
            lists = self._spark.read.schema(lists.schema).parquet(joined(self._path, self._files[at]["file"]))
        return lists.filter(F.col("item_id") == item_id)

    def get(self, item_id: Any, top_k: int = 10) -> list[Any]:
        """The first similar items; none for an unknown item. The filter reaches the scan."""
        if top_k <= 0:
            raise ValueError("top_k must be positive")
        found = self.of(item_id)
        row = found.select(F.slice("similar_items_sku_list", 1, top_k)).first() if found is not None else None
        return list(row[0]) if row and row[0] else []

    def get_many(self, items: DataFrame, top_k: int = 10) -> DataFrame:
        """(item_id, similar_items) for each distinct item of a table, an empty list for an unknown one."""
        if top_k <= 0:
            raise ValueError("top_k must be positive")
        asked = items.select("item_id").filter("item_id IS NOT NULL").distinct()
        found = asked.join(self._lists, "item_id", "left")
        none = F.array().cast(dict(self._lists.dtypes)["similar_items_sku_list"])
        return found.select("item_id", F.coalesce(F.slice("similar_items_sku_list", 1, top_k), none).alias("similar_items"))
