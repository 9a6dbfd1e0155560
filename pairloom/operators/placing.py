"""Places of rows within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.sources.files import staged


def placed_in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], place: str) -> DataFrame:
    """``df`` with each row's number, from 1, in the order of its group.

    Rows are dealt in ranges of group and order together, so a group that holds most rows is many ranges. Each range numbers
    its own rows, and what lies before it in the group, a sum for each range, is added. Rows are written once between the
    two, as ranges must not be drawn anew. Equal rows stay in one range, where any order of them is alike.
    """
    dealt = staged(df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = dealt.groupBy(*keys, "_range").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order))
    return dealt.withColumn("_own", own).join(sizes, [*keys, "_range"]).withColumn(place, F.col("_before") + F.col("_own")).drop("_own", "_before", "_range")
