"""Prefix trie of conversations with subtree totals by time-forward processing (operator 13).

A node is a distinct sequence of first turns. Turns become checksums at once, so texts aren't shuffled. A prefix is known
by the exclusive-or of its turns' checksums, each with its place, twice 64 bits; that and places come from sums of ranges:
turns are dealt in ranges of (conversation, turn), so that a hot conversation is many ranges, each is counted by itself,
and what lies before a range is added.

Totals go bottom-up. A node's weight is the number of turns at and below it in its members, which bounds its subtree.
Nodes beyond a weight are heavy; a light node below a heavy one is the root of a light subtree. Light subtrees are dealt
into shards, where time-forward processing (``time_forward.py``) hands totals from each node to its parent through a
spilling queue; then the sums of light roots go to their heavy parents. Heavy nodes are processed in the same way, in
shards of a band of depths each, then across the bands' roots, and once more in the bands with what comes from below. No
shard grows with the input: a heavy level has at most ``HEAVY`` nodes, a light subtree at most its weight.

Defined results: turns go by number, null first, ties by the checksum of role and text; null role or text is empty;
repeated rows are turns each; rows without a conversation are left out; very long texts are read whole (their length
counts, and they are told apart by two 64-bit checksums); a conversation without turns is a member of the root alone; an
empty table has no nodes. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.llm.common import bound_batches, cut_lineage, distinct_names, read_table
from pairloom.llm.time_forward import NODE, TOTALS, forward

#: The query's openings: conversation c starts with up to SHARED_TURNS - 1 turns of conversation c - c % SHARED_BY.
SHARED_BY, SHARED_TURNS = 100, 6
#: Weight of a light subtree at least; heavy nodes of a level at most; depths of a band.
LIGHT, HEAVY, BAND = 20_000, 100_000, 4096
#: Bytes of a piece of a list of ids.
PIECE = 1 << 16
KEY = ["depth", "k1", "k2"]
_NODE = [c.split()[0] for c in NODE.split(", ")]


def _checksums(place: Column, h1: Column, h2: Column) -> tuple[Column, Column]:
    return F.xxhash64(place.cast("long"), h1, h2), F.xxhash64(F.lit(1), place.cast("long"), h1, h2)


def _before(values: dict[str, Column]) -> dict[str, Column]:
    """Aggregates over the ranges of a conversation that come before."""
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return {name: F.coalesce(value.over(before), F.lit(0).cast("long")) for name, value in values.items()}


def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, i, h1, h2, chars): turns with their place from 0, the range they were dealt to and checksums."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = distinct_names(conversations, "conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL")
    turns = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(role, text).alias("h1"), F.xxhash64(F.lit(1), role, text).alias("h2"), F.char_length(text).cast("long").alias("chars"))
    order = ["turn", "h1", "h2"]
    dealt = cut_lineage(turns.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()))
    ranges = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    ranges = ranges.select("conv_id", "part", *[c.alias(k) for k, c in _before({"before": F.sum("n")}).items()])
    placed = dealt.withColumn("i", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)).cast("long") - 1)
    return cut_lineage(placed.join(ranges, ["conv_id", "part"]).select("conv_id", "part", (F.col("i") + F.col("before")).alias("i"), "h1", "h2", "chars"))


def prefixes(placed: DataFrame, shared_by: int | None = None, shared_turns: int = SHARED_TURNS) -> DataFrame:
    """A row for each conversation and depth: (conv_id, depth, k1, k2, up1, up2, chars, turns); depth 0 is the root.

    With ``shared_by``, the first h turns of conversation c, h being the CRC-32 of its decimal number modulo
    ``shared_turns``, are those of conversation c - c % shared_by.
    """
    none, c = F.lit(0).cast("long"), F.col("conv_id")
    ranges = placed.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    convs = ranges.groupBy("conv_id").agg(F.sum("n").alias("n"))
    if shared_by:
        base = c - c % shared_by
        openings = placed.filter((base == c) & (F.col("i") < shared_turns - 1)).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("i", "h1", "h2", "chars"))).alias("opening"))
        convs = convs.withColumn("h", F.when(base == c, none).otherwise(F.crc32(c.cast("string").cast("binary")) % shared_turns)).withColumn("base", base)
        convs = convs.join(openings.withColumnRenamed("conv_id", "base"), "base", "left").drop("base")
        convs = convs.withColumn("opening", F.when(F.col("h") > 0, F.slice("opening", 1, F.greatest(F.col("h"), F.lit(1)).cast("int"))))
    else:
        convs = convs.withColumn("h", none).withColumn("opening", F.lit(None).cast("array<struct<i:bigint,h1:bigint,h2:bigint,chars:bigint>>"))
    convs = convs.withColumn("opening", F.coalesce("opening", F.array().cast("array<struct<i:bigint,h1:bigint,h2:bigint,chars:bigint>>"))).withColumn("m", F.size("opening").cast("long"))

    def upto(turns: Column, k: int) -> Column:
        return F.aggregate(turns, none, lambda a, t: a.bitwiseXOR(_checksums(t["i"], t["h1"], t["h2"])[k]))

    convs = cut_lineage(convs.select("conv_id", "h", "m", "opening", (F.col("m") + F.greatest(F.col("n") - F.col("h"), none)).alias("turns"), upto(F.col("opening"), 0).alias("o1"), upto(F.col("opening"), 1).alias("o2")))
    own = placed.join(ranges.select("conv_id", "part").join(convs.drop("opening"), "conv_id"), ["conv_id", "part"]).filter("i >= h").withColumn("depth", F.expr("i - h + m + 1"))
    e1, e2 = _checksums(F.col("depth") - 1, F.col("h1"), F.col("h2"))
    own = cut_lineage(own.select("conv_id", "part", "depth", e1.alias("e1"), e2.alias("e2"), "chars", "turns", "o1", "o2"))
    sums = own.groupBy("conv_id", "part").agg(F.bit_xor("e1").alias("s1"), F.bit_xor("e2").alias("s2"))
    sums = sums.select("conv_id", "part", *[v.alias(k) for k, v in _before({"b1": F.bit_xor("s1"), "b2": F.bit_xor("s2")}).items()])
    running = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumns({"r1": F.bit_xor("e1").over(running), "r2": F.bit_xor("e2").over(running)}).join(sums, ["conv_id", "part"])
    keys = [F.col(f"r{k}").bitwiseXOR(F.col(f"b{k}")).bitwiseXOR(F.col(f"o{k}")) for k in (1, 2)]
    own = own.select("conv_id", "depth", *[key.alias(f"k{k}") for k, key in enumerate(keys, 1)], *[key.bitwiseXOR(F.col(f"e{k}")).alias(f"up{k}") for k, key in enumerate(keys, 1)], "chars", "turns")
    heads = [[upto(F.slice("opening", F.lit(1), F.col("depth").cast("int") - less), k) for k in (0, 1)] for less in (0, 1)]
    opening = convs.filter("m > 0").withColumn("depth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    opening = opening.select("conv_id", "depth", heads[0][0].alias("k1"), heads[0][1].alias("k2"), heads[1][0].alias("up1"), heads[1][1].alias("up2"), F.element_at("opening", F.col("depth").cast("int"))["chars"].alias("chars"), "turns")
    root = convs.select("conv_id", none.alias("depth"), none.alias("k1"), none.alias("k2"), F.lit(None).cast("long").alias("up1"), F.lit(None).cast("long").alias("up2"), none.alias("chars"), "turns")
    return cut_lineage(own.unionByName(opening).unionByName(root))


def _made(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), shape, strict=True)], schema=shape)


def ends(rows: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256): SHA-256 of the sorted ids of the conversations that end at a node.

    Ids are sorted in ranges, which split a hot node, and become pieces of text; only the checksum itself, which is
    sequential, is made in one task for each node, from a stream of pieces.
    """
    done = rows.filter("depth = turns").select(*KEY, "conv_id")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, first, ids, size, rows, held = None, 0, [], 0, [], 0
        shape = pa.schema([*((k, pa.int64()) for k in KEY), ("first", pa.int64()), ("ids", pa.string())])
        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != of or size > PIECE:
                    if ids:
                        rows.append((*of, first, ",".join(ids)))
                    held += size
                    if held > 16 * PIECE:
                        yield _made(rows, shape)
                        rows, held = [], 0
                    of, first, ids, size = key, conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield _made([*rows, (*of, first, ",".join(ids))], shape)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, digest, rows = None, hashlib.sha256(), []
        shape = pa.schema([*((k, pa.int64()) for k in KEY), ("ends_sha256", pa.string())])
        for batch in batches:
            for *key, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != of:
                    if of is not None:
                        rows.append((*of, digest.hexdigest()))
                    of, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if rows:
                yield _made(rows, shape)
                rows = []
        if of is not None:
            yield _made([(*of, digest.hexdigest())], shape)

    cut = done.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").mapInArrow(pieces, "depth long, k1 long, k2 long, first long, ids string")
    return cut.repartition(*KEY).sortWithinPartitions(*KEY, "first").drop("first").mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def _forward(nodes: DataFrame) -> DataFrame:
    return nodes.select(*_NODE).repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "k1", "k2").mapInArrow(forward, TOTALS)


def _up(nodes: DataFrame, *more: Column | str) -> DataFrame:
    """Rows under the keys of their parents."""
    return nodes.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("up1").alias("k1"), F.col("up2").alias("k2"), *more)


def totals(nodes: DataFrame, rows: DataFrame, light: int, band: int = BAND) -> DataFrame:
    """(depth, k1, k2, n_children, n_leaves, saved) of every node."""
    none = F.lit(0).cast("long")
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")).withColumns({"children": none, "leaves": none})
    heavy = nodes.filter(F.col("weight") > light)
    small = nodes.filter(F.col("weight") <= light)
    roots = small.join(heavy.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("up1"), F.col("k2").alias("up2")), ["depth", "up1", "up2"], "left_semi")
    roots = cut_lineage(roots.unionByName(small.filter("depth = 0")).select(*KEY, "up1", "up2"))
    shard = F.xxhash64(*KEY)
    members = rows.join(roots.select(*KEY), KEY).select("conv_id", shard.alias("shard"))  # a conversation enters one light subtree at most
    done = cut_lineage(_forward(small.join(members, "conv_id")))
    if not heavy.head(1):
        return done
    below = done.join(roots, KEY)
    given = _up(below, "n_leaves", "saved").groupBy(*KEY).agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("more"))
    heavy = heavy.drop("children", "leaves").join(given, KEY, "left").withColumn("saved", F.col("saved") + F.coalesce("more", none))
    tops = _up(heavy.filter(F.col("depth") % band == 0)).groupBy(*KEY).agg(F.count("*").alias("tops"))
    heavy = heavy.join(tops, KEY, "left").withColumn("children", F.coalesce("children", none) + F.coalesce("tops", none)).withColumn("leaves", F.coalesce("leaves", none))
    heavy = cut_lineage(heavy.withColumn("shard", F.floor(F.col("depth") / band)).select(*_NODE, "conv_id"))
    # the first of a band hands nothing on within it
    inner = F.col("depth") % band > 0
    local = cut_lineage(_forward(heavy.withColumns({c: F.when(inner, F.col(c)) for c in ("up1", "up2")})))
    firsts = heavy.filter((F.col("depth") % band == 0) & (F.col("depth") > 0))
    if not firsts.head(1):
        return done.unionByName(local)
    # across the bands' roots: the parent of one is the root of the band above, on the path of any of its members
    level = F.col("depth") / band
    path = rows.filter(F.col("depth") % band == 0).select("conv_id", (F.col("depth") + band).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    linked = firsts.select(*KEY, "conv_id", "up1", "up2").join(path, ["conv_id", "depth"]).join(local.drop("n_children"), KEY)
    across = linked.select(none.alias("shard"), level.cast("long").alias("depth"), "k1", "k2", F.col("p1").alias("up1"), F.col("p2").alias("up2"), F.lit(1).cast("long").alias("children"), F.col("n_leaves").alias("leaves"), "saved")
    summed = _forward(across).select((F.col("depth") * band).alias("depth"), "k1", "k2", "n_leaves", "saved")
    passed = _up(firsts.select(*KEY, "up1", "up2").join(summed, KEY), "n_leaves", "saved").groupBy(*KEY).agg(F.sum("n_leaves").alias("add_leaves"), F.sum("saved").alias("add_saved"))
    heavy = heavy.join(cut_lineage(passed), KEY, "left").withColumns({"leaves": F.col("leaves") + F.coalesce("add_leaves", none), "saved": F.col("saved") + F.coalesce("add_saved", none)})
    return done.unionByName(_forward(heavy.withColumns({c: F.when(inner, F.col(c)) for c in ("up1", "up2")})))


def prefix_trie(conversations: DataFrame, shared_by: int | None = None) -> DataFrame:
    """The trie's nodes: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    bound_batches(conversations.sparkSession)
    rows = prefixes(placed_turns(conversations), shared_by)
    nodes = rows.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("up1").alias("up1"), F.max("up2").alias("up2"), F.max("chars").alias("chars"), F.sum(F.col("turns") - F.col("depth") + 1).alias("weight"))
    nodes = cut_lineage(nodes)
    light = max(LIGHT, rows.count() // HEAVY)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(totals(nodes, rows, light), KEY).join(ends(rows), KEY, "left").join(parents, ["depth", "up1", "up2"], "left")
    nobody = F.lit(hashlib.sha256().hexdigest())
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nobody).alias("ends_sha256"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of all conversations, rebuilt with shared openings."""
    return prefix_trie(read_table(spark, sf_dir, "conversations"), SHARED_BY)
