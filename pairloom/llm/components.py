"""Connected components of an undirected graph by alternating large-star and small-star steps.

Each step joins edges with the least neighbour of each node. The least neighbours are written first, so both sides of
the join are dealt anew and Spark can split a node with very many neighbours. Nothing is gathered on the driver but
a count and a checksum. A step's tables are deleted once the next step is written. Tables have a file for every ``ROWS`` edges, so that a few edges aren't spread over as many files
as there are shuffle partitions.

Defined results: null nodes are dropped with their edges, loops and repeated edges change nothing, ties can't be, as nodes
are told apart by their ids; no edges give no rows. Columns beyond a and b are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import cut_lineage, drop_stored, recorded

#: Edges of a file, and files at least.
ROWS, FILES = 100_000, 8


def _with_least(edges: DataFrame, files: int) -> DataFrame:
    """Rows (a, b, m): m is the least of a and all b beside it."""
    least = cut_lineage(edges.groupBy("a").agg(F.min("b").alias("m")).coalesce(files))
    return edges.join(least, "a").select("a", "b", F.least("a", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b) but the roots, which are the least nodes."""
    with recorded() as kept:
        now = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state or not new[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state, files = new, max(FILES, new[0] // ROWS)
        with recorded() as made:
            both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
            large = cut_lineage(_with_least(both, files).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct().coalesce(files))
            small = _with_least(large, files)
            small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
            now = cut_lineage(small.filter("a <> b").distinct().coalesce(files))
        drop_stored(edges.sparkSession, kept + made[:-1])
        kept = made[-1:]
