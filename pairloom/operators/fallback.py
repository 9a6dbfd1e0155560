"""Completion of short lists from popularity and catalogue metadata."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.aggregate import with_weighted_counts
from pairloom.schemas import CONTRACTS, RAW_COUNTS, WEIGHTED_COUNTS
from pairloom.sources.files import staged

# Level labels in order, and the order of popularity (all descending, ties to the smaller id).
LEVELS = {
    "category_type": "fallback_category_type_popular",
    "category": "fallback_category_popular",
    "type": "fallback_type_popular",
    "brand": "fallback_brand_popular",
    "global": "fallback_global_popular",
}
POPULARITY_ORDER = ("unique_users", "to_cart_count", "favorites_count", "clicks_count", "views_count", "events_count")
_KEYS: dict[str, tuple[str, ...]] = {"category_type": ("category_id", "type"), "category": ("category_id",), "type": ("type",), "brand": ("brand",)}


@dataclass(frozen=True)
class FallbackSettings:
    enabled: bool = False
    top_k: int = 20
    candidate_pool_size: int | None = None
    global_candidate_pool_size: int | None = None
    metadata_candidate_pool_size: int | None = None
    min_item_events: int = 1
    include_cold_start_items: bool = True
    include_catalog_only_sources: bool = False
    enable_category_type: bool = True
    enable_category: bool = True
    enable_type: bool = True
    enable_brand: bool = False
    enable_global: bool = True

    def __post_init__(self) -> None:
        sizes = (self.top_k, self.min_item_events, *(s for s in (self.candidate_pool_size, self.global_candidate_pool_size, self.metadata_candidate_pool_size) if s is not None))
        if min(sizes) <= 0:
            raise ValueError("top_k, min_item_events and pool sizes must be positive")

    @classmethod
    def from_config(cls, config: Mapping[str, Any], top_k: int = 20) -> FallbackSettings:
        """From ``fallback`` and ``business.fallback``, of which the latter wins."""
        given = {**(config.get("fallback") or {}), **((config.get("business") or {}).get("fallback") or {})}
        known = {k: v for k, v in given.items() if k in cls.__dataclass_fields__ and v is not None}
        return cls(**{"top_k": top_k, **known})

    def pool(self, level: str) -> int:
        size = self.candidate_pool_size or max(10 * self.top_k, 100)
        return (self.global_candidate_pool_size if level == "global" else self.metadata_candidate_pool_size) or size

    def levels(self) -> list[str]:
        return [level for level in LEVELS if getattr(self, f"enable_{level}")]


def _popularity_order() -> list[Column]:
    return [*(F.coalesce(c, F.lit(0)).desc() for c in POPULARITY_ORDER), F.col("item_id").asc()]


def catalogue(products: DataFrame) -> DataFrame:
    """One row for each item, the first by its other columns."""
    first = Window.partitionBy("item_id").orderBy("name", "brand", "type", "category_id")
    return products.filter("item_id IS NOT NULL").withColumn("_n", F.row_number().over(first)).filter("_n = 1").select("item_id", "name", "brand", "type", "category_id")


def _asked(settings: FallbackSettings, metadata: bool) -> dict[str, list[Column]]:
    """The two keys under which an item belongs to each level's pools; a level whose metadata it lacks has a null."""
    found = {}
    for level in settings.levels():
        keys = _KEYS.get(level, ())
        if metadata or not keys:
            found[level] = [F.col(k).cast("string") for k in keys] + [F.lit("")] * (2 - len(keys))
    return found


def candidate_pools(popularity: DataFrame, products: DataFrame | None, settings: FallbackSettings) -> DataFrame:
    """(level, k1, k2, item_id, place): each key's most popular items.

    A pool is cut to what can be used: a list of top_k takes at most that many from it and passes over one, itself. Every
    item is read once, under all its keys; tasks cut pools before they are shuffled, also the one of all items.
    """
    ranked = popularity.filter(F.col("item_id").isNotNull() & (F.coalesce("events_count", F.lit(0)) >= settings.min_item_events))
    if products is not None:
        ranked = ranked.join(catalogue(products), "item_id", "left")
    limits = {level: min(settings.pool(level), settings.top_k + 1) for level in settings.levels()}
    keys = [F.struct(F.lit(level).alias("level"), k[0].alias("k1"), k[1].alias("k2"), F.lit(limits[level]).alias("most")) for level, k in _asked(settings, products is not None).items()]
    rows = ranked.select("item_id", *POPULARITY_ORDER, F.explode(F.array(*keys)).alias("_k")).select("item_id", *POPULARITY_ORDER, "_k.*").filter("k1 IS NOT NULL AND k2 IS NOT NULL")
    best = Window.partitionBy("level", "k1", "k2").orderBy(*_popularity_order())
    placed = rows.withColumn("place", F.row_number().over(best).cast("long")).filter(F.col("place") <= max(limits.values()))
    return placed.filter(F.col("place") <= F.col("most")).select("level", "k1", "k2", "item_id", "place")


def merge_fallback(recommendations: DataFrame, popularity: DataFrame, products: DataFrame | None, settings: FallbackSettings, groups: DataFrame | None = None) -> DataFrame:
    """Recommendations, each source's list filled up to top_k.

    With ``groups``, a table of a few rows, recommendations have its columns too, and each group is filled by itself.

    Behavioural rows come first. A candidate belongs to the first level that yields it; fallback rows have score and
    raw counts 0 and no weighted counts. With an empty popularity pool the recommendations come back as they are.

    A list and the pools of its item, one for each level, are short arrays, so an item is filled where it is: its pools
    are put one after the other, and as many candidates are taken as it lacks. Nothing is exploded before that, and
    recommendations are read once. Pools are written first, so Spark knows their size and broadcasts them only if they are
    small; else a join by their key splits large keys. Popularity is written too, as it is read for several ends. Without a
    catalogue and the level of all items there is nothing to fill from.
    """
    asked = _asked(settings, products is not None)
    if not settings.enabled or not asked:
        return recommendations
    popularity = staged(popularity)
    usable = popularity.filter(F.col("item_id").isNotNull() & (F.coalesce("events_count", F.lit(0)) >= settings.min_item_events))
    if usable.isEmpty():
        return recommendations
    base = with_weighted_counts(recommendations) if set(RAW_COUNTS) <= set(recommendations.columns) else recommendations
    by = groups.columns if groups is not None else []
    item = [*by, "item_id"]
    own = Window.partitionBy(*item).orderBy("rank", "similar_item_id")
    base = base.filter("item_id IS NOT NULL AND similar_item_id IS NOT NULL AND item_id <> similar_item_id")
    once = Window.partitionBy(*item, "similar_item_id").orderBy("rank")
    base = base.withColumn("_once", F.row_number().over(once)).filter("_once = 1").withColumn("_place", F.row_number().over(own).cast("long")).filter(F.col("_place") <= settings.top_k).drop("_once")
    extra, kinds = [c for c in base.columns if c not in (*CONTRACTS["recommendations"], *by, "_place")], dict(base.dtypes)
    row = F.struct(F.col("_place").alias("rank"), "similar_item_id", "score", "source", *extra)
    lists = base.groupBy(*item).agg(F.sort_array(F.collect_list(row)).alias("_own"))
    sources = usable.select("item_id").distinct() if settings.include_cold_start_items else None
    if settings.include_catalog_only_sources and products is not None:
        known = products.filter("item_id IS NOT NULL").select("item_id")
        sources = known.distinct() if sources is None else sources.unionByName(known).distinct()
    if sources is not None:
        lists = lists.join(sources.join(F.broadcast(groups)) if groups is not None else sources, item, "full_outer")
    if products is not None:
        lists = lists.join(catalogue(products).drop("name"), "item_id", "left")
    pools = staged(candidate_pools(popularity, products, settings).groupBy("level", "k1", "k2").agg(F.sort_array(F.collect_list(F.struct("place", "item_id")))["item_id"].alias("items")))
    for level, key in asked.items():
        of = pools.filter(F.col("level") == level).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("items").alias(f"_{level}"))
        # the pool of all items is one row
        lists = lists.join(F.broadcast(of.select(f"_{level}")), how="left") if level == "global" else lists.join(of, (key[0] == F.col("_k1")) & (key[1] == F.col("_k2")), "left").drop("_k1", "_k2")
    kind = kinds["item_id"]
    none = F.array().cast(f"array<{kind}>")
    lists = lists.withColumns({f"_{level}": F.coalesce(f"_{level}", none) for level in asked} | {"_taken": F.coalesce(F.col("_own")["similar_item_id"], none)})
    offered = F.array_distinct(F.concat(*(F.col(f"_{level}") for level in asked)))
    fit = F.filter(offered, lambda x: (x != F.col("item_id")) & ~F.array_contains("_taken", x))
    lists = lists.withColumn("_fill", F.slice(fit, 1, settings.top_k - F.size("_taken")))
    zero = {c: F.lit(0).cast("long") for c in (*RAW_COUNTS, "unique_users", "unique_sessions")}

    def filled(x: Column, k: Column) -> Column:
        label = F.lit(None).cast("string")
        for level in reversed(asked):
            label = F.when(F.array_contains(f"_{level}", x), F.lit(LEVELS[level])).otherwise(label)
        return F.struct((F.size("_taken") + k + 1).cast("long").alias("rank"), x.alias("similar_item_id"), F.lit(0.0).cast(kinds["score"]).alias("score"), label.alias("source"), *(zero.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in extra))

    rows = F.concat(F.coalesce("_own", F.transform(none, lambda x: filled(x, F.lit(0)))), F.transform("_fill", filled))
    return lists.select(*item, F.explode(rows).alias("_r")).select(*item, "_r.*").select(*by, *CONTRACTS["recommendations"], *extra)
