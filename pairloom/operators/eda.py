"""Exploratory queries over events and the catalogue."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_values(df: DataFrame, column: str, n: int = 30) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), column).limit(n)


def user_activity(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.count("*").alias("events"))


def _by_value(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs (column _n): quantiles are taken over these, not over all rows in one task."""
    return df.groupBy(column).agg(F.count("*").alias("_n"))


def activity_quantiles(events: DataFrame, quantiles: Sequence[float] = (0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    users = _by_value(user_activity(events), "events")
    return users.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("users"), *(F.percentile("events", F.lit(q), F.col("_n")).alias(f"p{round(100 * q)}") for q in quantiles), F.max("events").alias("most"))


def heavy_users(events: DataFrame, quantile: float = 0.99) -> DataFrame:
    """One row: users at or above a quantile of activity, their events, and their share of all."""
    users = _by_value(user_activity(events), "events")
    cut = users.agg(F.percentile("events", F.lit(quantile), F.col("_n")).alias("_cut"), F.sum(F.col("events") * F.col("_n")).alias("_all"))
    above = users.join(F.broadcast(cut)).filter(F.col("events") >= F.col("_cut")).withColumn("_e", F.col("events") * F.col("_n"))  # the cut is one row
    return above.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("users"), F.sum("_e").alias("events"), (F.sum("_e") / F.first("_all")).alias("share"))


def popularity_concentration(popularity: DataFrame, tops: Sequence[int] = (10, 100, 1000)) -> DataFrame:
    """Share of all events that the most popular n items have."""
    largest = popularity.select("events_count", "item_id").orderBy(F.desc("events_count"), "item_id").limit(max(tops))
    ranked = largest.withColumn("place", F.row_number().over(Window.orderBy(F.desc("events_count"), "item_id")))  # over the limited rows
    sums = ranked.agg(*(F.sum(F.when(F.col("place") <= n, F.col("events_count"))).alias(f"_{n}") for n in tops))
    total = popularity.agg(F.sum("events_count").alias("_all"))
    each = F.explode(F.array(*(F.struct(F.lit(n).cast("long").alias("top_n"), F.col(f"_{n}").alias("events_count")) for n in tops)))
    return sums.join(F.broadcast(total)).select(each.alias("t"), "_all").select("t.top_n", "t.events_count", (F.col("t.events_count") / F.col("_all")).alias("share"))


def top_per_action(events: DataFrame, n: int = 100) -> DataFrame:
    found = events.groupBy("action_type", "item_id").agg(F.count("*").alias("events"))
    best = Window.partitionBy("action_type").orderBy(F.desc("events"), "item_id")
    return found.withColumn("place", F.row_number().over(best).cast("long")).filter(F.col("place") <= n)


def search_quality(raw: DataFrame) -> DataFrame:
    """One row: searches, and missing, empty, blank and distinct queries."""
    q = F.col("search_query")
    return raw.agg(F.count("*").alias("rows"), F.count_if(q.isNull()).alias("nulls"), F.count_if(q == "").alias("empty"), F.count_if((q != "") & (F.trim(q) == "")).alias("blank"), F.count_distinct(F.lower(F.trim(q))).alias("distinct"))


def top_queries(raw: DataFrame, n: int = 50) -> DataFrame:
    cleaned = raw.select(F.lower(F.trim("search_query")).alias("query")).filter("query <> ''")
    return top_values(cleaned, "query", n)


def date_action_summary(events: DataFrame) -> DataFrame:
    found = events.groupBy("event_date", "action_type").agg(F.count("*").alias("events"))
    return found.withColumn("day_share", F.col("events") / F.sum("events").over(Window.partitionBy("event_date")))


def widget_profile(events: DataFrame) -> DataFrame:
    found = events.groupBy("widget_name", "action_type").agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))
    return found.withColumn("share", F.col("events") / F.sum("events").over(Window.partitionBy()))


def catalogue_reconciliation(events: DataFrame, products: DataFrame) -> DataFrame:
    """One row: items in both, in the log alone, in the catalogue alone."""
    log = events.filter("item_id IS NOT NULL").select("item_id").distinct().withColumn("_l", F.lit(1))
    cat = products.filter("item_id IS NOT NULL").select("item_id").distinct().withColumn("_c", F.lit(1))
    both = log.join(cat, "item_id", "full_outer")
    return both.agg(F.count_if(F.expr("_l IS NOT NULL AND _c IS NOT NULL")).alias("matched"), F.count_if(F.expr("_c IS NULL")).alias("log_only"), F.count_if(F.expr("_l IS NULL")).alias("catalogue_only"))


def sampled_session_lengths(sessions: DataFrame, per_mille: int = 50, quantiles: Sequence[float] = (0.5, 0.9, 0.99), hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row: quantiles of session lengths over a hashed sample of users, the feature of this query; any hash will do."""
    users = sessions.filter(F.pmod(hashed(F.col("user_id")), F.lit(1000)) < per_mille)
    lengths = _by_value(users.groupBy("user_id", "session_index").agg(F.count("*").alias("n")), "n")
    return lengths.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("sessions"), *(F.percentile("n", F.lit(q), F.col("_n")).alias(f"p{round(100 * q)}") for q in quantiles))


def item_catalogue(recommendations: DataFrame, products: DataFrame) -> DataFrame:
    """Recommended items with a name and how many similar items they have."""
    names = products.groupBy("item_id").agg(F.min("name").alias("item_name"))
    return recommendations.groupBy("item_id").agg(F.count("*").alias("similar_items")).join(names, "item_id", "left")


def source_distribution(recommendations: DataFrame) -> DataFrame:
    return recommendations.groupBy(F.coalesce("source", F.lit("unknown")).alias("source")).agg(F.count("*").alias("rows"))


def search_items(catalogue: DataFrame, query: str) -> DataFrame:
    """Items whose id is the query; if there are none, those whose name contains it in any case."""
    q = query.strip()
    exact = catalogue.filter(F.col("item_id").cast("string") == q)
    return catalogue.filter(F.lower(F.coalesce("item_name", F.lit(""))).contains(q.lower())) if exact.isEmpty() else exact


def preview(recommendations: DataFrame, items: int = 20, top_k: int = 10, products: DataFrame | None = None) -> DataFrame:
    """The first recommendations of the first items, by id, with the names of both items if there is a catalogue."""
    first = recommendations.select("item_id").distinct().orderBy("item_id").limit(items)
    found = recommendations.filter(F.col("rank") <= top_k).join(first, "item_id", "left_semi")
    if products is None:
        return found
    name = products.groupBy("item_id").agg(F.min("name").alias("item_name"))
    similar = name.select(F.col("item_id").alias("similar_item_id"), F.col("item_name").alias("similar_item_name"))
    return found.join(name, "item_id", "left").join(similar, "similar_item_id", "left").select(*recommendations.columns, "item_name", "similar_item_name")
