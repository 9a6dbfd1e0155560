"""The driver's tables as raw events and products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.schemas import CONTRACTS

# Event types as actions.
ACTION_OF_TYPE = {"view": "view", "click": "click", "signup": "favorite", "purchase": "to_cart", "error": "search"}


def _mapped(column: str, mapping: dict[str, str]) -> F.Column:
    chain = F.lit(None).cast("string")
    for k, v in mapping.items():
        chain = F.when(F.col(column) == k, F.lit(v)).otherwise(chain)
    return chain


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a click stream: the item is in the properties, the widget follows from the value."""
    return _as_raw(spark.read.parquet(f"{sf_dir}/events.parquet"))


def raw_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream of the table's files."""
    path = f"{sf_dir}/events.parquet"
    return _as_raw(spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*"))  # a pattern may match a single file, which a plain path may not be


def _as_raw(events: DataFrame) -> DataFrame:
    e = events.withColumns({
        "date": F.to_date("ts"), "timestamp": F.col("ts"), "action_type": _mapped("event_type", ACTION_OF_TYPE),
        "widget_name": F.when(F.col("value") >= 10, "product_detailed_page").otherwise("search_catalog_listing"),
        "search_query": F.lit(None).cast("string"), "item_id": F.get_json_object("props", "$.k").try_cast("long"),
    })
    return e.select(*CONTRACTS["raw_events"])


def basket_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a click stream: customers look at parts, a minute apart in each order."""
    lines, orders = spark.read.parquet(f"{sf_dir}/lineitem.parquet"), spark.read.parquet(f"{sf_dir}/orders.parquet")
    joined = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus").join(orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    ts = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_linenumber").cast("int"), F.lit(0))
    action = F.when(F.col("l_returnflag") == "A", "favorite").when(F.col("l_returnflag") == "R", "to_cart").when(F.col("l_linestatus") == "O", "view").otherwise("click")
    return joined.select(
        F.col("o_custkey").cast("long").alias("user_id"), F.to_date("o_orderdate").alias("date"), ts.alias("timestamp"), action.alias("action_type"),
        F.when(F.col("l_linestatus") == "O", "search_catalog_listing").otherwise("product_detailed_page").alias("widget_name"), F.lit(None).cast("string").alias("search_query"), F.col("l_partkey").cast("long").alias("item_id"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as a catalogue."""
    size = F.col("p_size").cast("long")
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").cast("long").alias("item_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), size.alias("category_id"), F.concat(F.lit("size_"), size.cast("string")).alias("category_name"))
