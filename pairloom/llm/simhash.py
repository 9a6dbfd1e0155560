"""SimHash near-duplicates over a Gray-order hierarchical index (operator 1).

A fingerprint of 64 bits is taken from the hashes of a text's word shingles. Two fingerprints are linked if they
differ in few bits; a document's group is what it reaches over links.

Copies share a fingerprint, so linking works on distinct fingerprints. Each is sent to one bucket for each of four
blocks of its bits: two fingerprints that differ in at most three bits agree in a block and meet there. A bucket with
many fingerprints is dealt again by four blocks of the bits that it doesn't share, which loses no pair for the same
reason; after four rounds 20 bits remain, which bounds a bucket (fingerprints are distinct). In a bucket the
fingerprints are sorted by Gray rank, which brings those of shared patterns together, and an index is built over them:
a node holds the bits that all fingerprints below it share and its parent doesn't, and a search adds up differences
from the root down and leaves out whole groups beyond the limit. A bucket gives one star of edges for each of its
connected groups, never all pairs.

Defined results: null and empty texts have fingerprint zero and are linked like others; texts of fewer words than a
shingle are one shingle; very long texts are read whole; a bit that half the shingles have is 0; repeated rows stay; a
null id takes part, and a group without any id has a null component; an empty table gives an empty result. Columns
beyond id and text are not read; ``keep_one`` returns all of them, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import bound_batches, cut_lineage, distinct_names, read_table, text_key, texts, whole_rows
from pairloom.llm.components import components

SHINGLE_WORDS = 3
MAX_DIFFERENCES = 3
SEED = 42
#: Fingerprints of a bucket beyond which it is dealt again.
BUCKET_LIMIT = 2048
#: Children of an index node.
FAN_OUT = 16
#: Pairs of a query and an index node that are looked at at once.
FRONTIER = 1 << 21
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash: a bit is set if it is set in over half the shingles' XXH64."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8").translate(_LOWER).split()
    if not words:
        return 0
    k = min(shingle_words, len(words))
    n = len(words) - k + 1
    shingles = map(b" ".join, zip(*(words[i : i + n] for i in range(k)), strict=True))
    hashes = np.zeros(-(-n // 255) * 255, np.uint64)
    hashes[:n] = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64, n)
    counts = np.empty((8, 8), np.int64)
    for bit in range(8):  # eight counters to a word, none beyond 255
        lanes = ((hashes >> np.uint64(bit)) & _LANES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
        counts[:, bit] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts.ravel() > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp long, key_a, key_b) for every row; the keys tell texts apart."""
    bound_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, shingle_words) for t in texts(batch.column(1))), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), batch.column(2), batch.column(3)], names=["doc_id", "fp", "key_a", "key_b"])

    key = text_key(F.col("text"))
    rows = distinct_names(docs, "doc_id", "text").select("doc_id", "text", key["a"].alias("key_a"), key["b"].alias("key_b"))
    return rows.mapInArrow(run, f"doc_id {id_type}, fp long, key_a long, key_b long")


def blocks(mask: int, parts: int = MAX_DIFFERENCES + 1) -> list[int]:
    """The bits outside ``mask`` in equal blocks, each joined to ``mask``; masks of 64 bits."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [round(k * len(free) / parts) for k in range(parts + 1)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _index(values: np.ndarray, first: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels from the leaves up as (start of each node in the level below, pattern, bits shared by all below).

    ``first`` has the index of the first value of each bucket; the highest level has one node for each bucket.
    """
    levels = [(np.arange(len(values)), values, np.full(len(values), ~np.uint64(0)))]
    sizes = np.diff(np.append(first, len(values)))
    low = high = values
    while True:
        start_of = np.cumsum(sizes) - sizes
        local = np.arange(sizes.sum()) - np.repeat(start_of, sizes)
        starts = np.flatnonzero(local % FAN_OUT == 0)
        low, high = np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)
        levels.append((starts, low, ~(low ^ high)))
        sizes = -(-sizes // FAN_OUT)
        if sizes.max() == 1:
            return levels


def links(values: np.ndarray, first: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions of values in the same bucket that differ in at most ``limit`` bits, searched from the roots down."""
    levels = _index(values, first)
    sizes = np.diff(np.append(first, len(values)))
    bucket = np.repeat(np.arange(len(first)), sizes)
    ahead = np.cumsum(sizes[bucket])
    at = 0
    while at < len(values):
        to = max(at + 1, int(np.searchsorted(ahead, (ahead[at - 1] if at else 0) + FRONTIER)))
        query = np.arange(at, to)
        node, gathered, above = bucket[query], np.zeros(len(query), np.uint8), np.zeros(len(query), np.uint64)
        for depth in range(len(levels) - 1, -1, -1):
            starts, pattern, shared = levels[depth]
            gathered = gathered + np.bitwise_count((values[query] ^ pattern[node]) & shared[node] & ~above)
            near = gathered <= limit
            query, node, gathered = query[near], node[near], gathered[near]
            if depth:
                above = shared[node]
                below = len(levels[depth - 1][1])
                n = np.append(starts, below)[node + 1] - starts[node]
                child = np.repeat(starts[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                query, gathered, above, node = np.repeat(query, n), np.repeat(gathered, n), np.repeat(above, n), child
        yield query[node < query], node[node < query]
        at = to


def _stars(values: np.ndarray, first: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """An edge from each value to the first of its connected group in the bucket."""
    label = np.arange(len(values))
    for a, b in links(values, first, limit):
        while len(a):
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(nearer := label[label], label):
                label = nearer
    moved = label != np.arange(len(values))
    return values[moved], values[label[moved]]


def gray_rank(column: F.Column) -> F.Column:
    """Place of a 64-bit word in the Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        column = column.bitwiseXOR(F.shiftrightunsigned(column, shift))
    return column


def fingerprint_links(fps: DataFrame, limit: int = MAX_DIFFERENCES, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Edges (a, b) that connect what is linked among distinct fingerprints (column fp), at most one for each and bucket."""
    if not 0 <= limit <= MAX_DIFFERENCES:
        raise ValueError("the blocks are cut for at most three differences")
    dealt = lambda rows, masks: rows.withColumn("mask", F.explode(masks)).withColumn("shared", F.col("fp").bitwiseAND(F.col("mask")))
    masks = blocks(0)
    rows, kept = dealt(fps.select("fp"), F.array(*[F.lit(_signed(m)) for m in masks])), []
    for _ in range(3):
        hot = cut_lineage(rows.groupBy("mask", "shared").count().filter(F.col("count") > bucket_limit).select("mask", "shared"))
        if hot.isEmpty():
            break
        kept.append(rows.join(hot, ["mask", "shared"], "left_anti").select("fp", "mask", "shared"))
        finer = {m: blocks(m) for m in masks}
        choose = F.create_map(*[x for m, f in finer.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(k)) for k in f]))])
        rows = dealt(rows.join(hot, ["mask", "shared"], "left_semi"), choose[F.col("mask")]).select("fp", "mask", "shared")
        masks = [k for f in finer.values() for k in f]
    for part in kept:
        rows = rows.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(rows: list[np.ndarray]) -> pa.RecordBatch:
            key, values = rows[1:], rows[0].view(np.uint64)
            first = np.flatnonzero(np.append(True, (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])))
            a, b = _stars(values, first, limit)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            rows = [c.to_numpy() for c in batch.columns[:3]]
            if not len(rows[0]):
                continue
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
            same = (held[1] == held[1][-1]) & (held[2] == held[2][-1])
            whole = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0  # the last bucket may go on
            if whole:
                yield solved([x[:whole] for x in held])
                held = [x[whole:] for x in held]
        if held is not None:
            yield solved(held)

    ordered = rows.repartition("mask", "shared").sortWithinPartitions("mask", "shared", gray_rank(F.col("fp")))
    return ordered.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, limit: int = MAX_DIFFERENCES) -> DataFrame:
    """(doc_id, key, fp, group, component_id) for every row: component_id is the least id that is reached over links.

    ``key`` tells the texts of an id apart, ``group`` groups of the same component_id.
    """
    of_docs = cut_lineage(fingerprints(docs, shingle_words))
    fps = cut_lineage(of_docs.groupBy("fp").agg(F.min("doc_id").alias("least")))
    stars = components(fingerprint_links(fps, limit))
    members = stars.select(F.col("node").alias("fp"), "root").unionByName(stars.select(F.col("root").alias("fp"), "root").distinct())
    members = cut_lineage(members.join(fps, "fp"))
    least = cut_lineage(members.groupBy("root").agg(F.min("least").alias("component_id")))
    linked = cut_lineage(members.join(least, "root").select("fp", "root", "component_id"))
    of_fp = cut_lineage(fps.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("group"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")))
    return of_docs.join(of_fp, "fp").select("doc_id", F.struct(F.col("key_a").alias("a"), F.col("key_b").alias("b")).alias("key"), "fp", "group", "component_id")


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row with the least id stays, one if it is repeated.

    Rows are told apart by id and text. Groups without any id are left as they are. Rows meet decisions in a shuffle at
    every size, so that the plan is one and needs grow with the input.
    """
    by = ["doc_id", "key"]
    rows = whole_rows(docs, "doc_id", "text").select("doc_id", text_key(F.col("text")).alias("key"), "row")
    first = groups.filter("doc_id = component_id")
    again = cut_lineage(first.groupBy("group").agg(F.count("*").alias("n"), F.min("key").alias("least"), F.first("doc_id").alias("doc_id")).filter("n > 1"))
    drop = groups.filter("doc_id <> component_id").select(*by)
    if again.isEmpty():
        return rows.join(cut_lineage(drop.distinct()).hint("shuffle_hash"), by, "left_anti").select("row.*")
    drop = drop.unionByName(first.join(again.select("group", "least"), "group").filter(F.col("key") != F.col("least")).select(*by))
    rest, again = rows.join(cut_lineage(drop.distinct()).hint("shuffle_hash"), by, "left_anti"), again.select("doc_id", F.col("least").alias("key"))
    once = rest.join(again, by, "left_semi").dropDuplicates(by)
    return rest.join(again, by, "left_anti").select("row.*").unionByName(once.select("row.*"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
