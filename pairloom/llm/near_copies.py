"""Near copies of a given similarity by wide SimHash fingerprints (operator 1, for shingle similarity).

The share of bits in which two SimHash fingerprints differ estimates the angle of their shingle vectors: 2 J / (1 + J)
is about the cosine at a Jaccard similarity J. 64 bits are too few to tell 0.8 from unlike texts and still find pairs
by blocks of equal bits, so this takes ``WORDS`` independent fingerprints of 64 bits.

1. Candidates. Texts that agree in a block of bits meet in a bucket. Blocks are as wide as the number of texts asks
   (``BUCKET_MEAN`` texts to a bucket of random bits) and as many as keep the chance that a pair of the similarity
   agrees in none below ``MISSED``; at 16 bits that are 40 blocks. In a bucket an index over Gray order links texts
   whose first ``COMPARED`` fingerprints differ in at most the limit, three deviations above what is expected, as a
   spanning forest of least differences. The first blocks join most of a group of copies; the others look only for
   pairs between groups, and index nodes that hold one group alone are passed over.
2. Confirmation. Groups of candidates meet with their sets of shingles, and texts are linked if the exact similarity is
   reached. Groups beyond ``MEETING`` texts first confirm the pairs of their forests, which leaves few parts; the texts
   outside the largest part then meet all others, in blocks.

Buckets of more than ``BUCKET_LIMIT`` texts are cut in the same way: parts by themselves first, then what isn't in the
bucket's largest group with all others. So no pair that meets is lost, and hot groups cost more than their size only
as far as they don't hang together.

What is missed: a pair that agrees in no block (``MISSED`` at the similarity, less above it) or exceeds the limit of bits
(1 or 2 in 1,000 at it), unless others connect it. What is found is exact.

Defined results: null and empty texts are copies of each other and of nothing else; texts of fewer words than a shingle
are one shingle; very long texts are read whole; texts of equal sets of shingles are copies; ties in differences go to
the lesser node and change no result, as all pairs between parts are tried; repeated rows stay and have one group; a null
id takes part, and a group without any id has a null component; an empty table gives an empty result. Columns beyond id
and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, floor, lgamma, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import bound_batches, cut_lineage, distinct_names, text_key, texts
from pairloom.llm.components import components
from pairloom.llm.simhash import _LANES, _LOWER, FAN_OUT, FRONTIER, SEED, gray_rank

SHINGLE_WORDS = 5
SIMILARITY = 0.8
WORDS, COMPARED = 10, 4
#: Bits of a block at least and at most, texts of a bucket aimed at, and chance that a pair agrees in no block.
BLOCK_BITS, MOST_BITS, BUCKET_MEAN, MISSED = 16, 32, 64, 0.05
#: Blocks of the first turn.
FIRST_BLOCKS = 8
#: Fingerprints of near copies at the similarity differ in more bits than expected half of the time; this many deviations are allowed.
DEVIATIONS = 3.0
#: Texts beyond which a bucket is cut, and a group of candidates, or bytes of its shingle sets.
BUCKET_LIMIT, MEETING, MEETING_BYTES = 8192, 2000, 32 << 20
#: Hot buckets or groups, of each turn, whose table, 32 bytes each, is sent to the executors; if there are more, only the largest are cut.
HOT_LIMIT = 500_000
_MIX = np.random.Generator(np.random.PCG64(SEED)).integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bit_limit(similarity: float = SIMILARITY, bits: int = 64 * COMPARED) -> int:
    """Bits in which near copies of a similarity differ, with the allowed deviations."""
    share = acos(2 * similarity / (1 + similarity)) / pi
    return floor(bits * share + DEVIATIONS * (bits * share * (1 - share)) ** 0.5)


def block_plan(n: int, similarity: float = SIMILARITY) -> list[np.ndarray]:
    """The bits of each block for ``n`` texts: neighbouring ones as long as there are any, then fixed random choices."""
    width = min(MOST_BITS, max(BLOCK_BITS, ceil(log2(max(n, 1) / BUCKET_MEAN))))
    share, bits, rng = acos(2 * similarity / (1 + similarity)) / pi, 64 * WORDS, np.random.Generator(np.random.PCG64(SEED))
    count = ceil(log(MISSED) / log(1 - (1 - share) ** width))
    if count * width > bits:  # blocks share bits: how many of all differ decides for all of them
        differ = np.arange(bits - width + 1)
        of = np.array([lgamma(bits + 1) - lgamma(d + 1) - lgamma(bits - d + 1) + d * log(share) + (bits - d) * log(1 - share) for d in differ])
        agree = np.exp([lgamma(bits - d + 1) - lgamma(bits - d - width + 1) - lgamma(bits + 1) + lgamma(bits - width + 1) for d in differ])
        while np.exp(of) @ (1 - agree) ** count > MISSED:
            count += ceil(count / 50)
    return [np.arange(k * width, (k + 1) * width) if (k + 1) * width <= bits else np.sort(rng.choice(bits, width, replace=False)) for k in range(count)]


def shingle_set(text: str, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of a text's distinct shingles in order."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    k = min(shingle_words, len(words))
    n = len(words) - k + 1
    return np.unique(np.fromiter((xxh64_intdigest(s, SEED) for s in map(b" ".join, zip(*(words[i : i + n] for i in range(k)), strict=True))), np.uint64, n))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """``WORDS`` fingerprints of 64 bits from re-mixed shingle hashes; zeros for none."""
    n, found = len(hashes), np.zeros(WORDS, np.uint64)
    if not n:
        return found
    padded = np.zeros(-(-n // 255) * 255, np.uint64)
    for w in range(WORDS):
        mixed = hashes * _MIX[w]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        padded[:n] = mixed
        counts = np.empty((8, 8), np.int64)
        for bit in range(8):
            lanes = ((padded >> np.uint64(bit)) & _LANES).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
            counts[:, bit] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        found[w] = np.packbits(2 * counts.ravel() > n, bitorder="little").view(np.uint64)[0]
    return found


def wide_fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, key_a, key_b, fp, shingles) for every row; fp has all fingerprints as bytes, shingles a hash of the set."""
    bound_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sums = [], np.zeros(len(batch), np.uint64)
            for row, t in enumerate(texts(batch.column(1))):
                hashes = shingle_set(t, shingle_words)
                fps.append(wide_fingerprint(hashes).tobytes())
                sums[row] = hashes.sum(dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(fps, pa.binary()), pa.array(sums.view(np.int64))], names=["doc_id", "key_a", "key_b", "fp", "shingles"])

    key = text_key(F.col("text"))
    rows = distinct_names(docs, "doc_id", "text").select("doc_id", "text", key["a"].alias("key_a"), key["b"].alias("key_b"))
    return rows.mapInArrow(run, f"doc_id {id_type}, key_a long, key_b long, fp binary, shingles long")


def pairs(values: np.ndarray, first: np.ndarray, limit: int, group: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows of a bucket within the limit, with their differences; rows of a bucket are in Gray order.

    The index: nodes over runs of rows hold the bits that all of them share. A query's differences add up from the root
    down over bits that a node shares and its parent doesn't; groups beyond the limit are left out as a whole, and so
    are nodes all of whose rows are of the query's own ``group``.
    """
    sizes = np.diff(np.append(first, len(values)))
    group = np.arange(len(values)) if group is None else group
    levels = [(np.arange(len(values)), values, np.full_like(values, ~np.uint64(0)), group, group)]
    low = high = values
    least = most = group
    count = sizes
    while True:
        local = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        starts = np.flatnonzero(local % FAN_OUT == 0)
        low, high = np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)
        least, most = np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts)
        levels.append((starts, low, ~(low ^ high), least, most))
        count = -(-count // FAN_OUT)
        if count.max() == 1:
            break
    bucket = np.repeat(np.arange(len(first)), sizes)
    ahead, at = np.cumsum(sizes[bucket]), 0
    while at < len(values):
        to = max(at + 1, int(np.searchsorted(ahead, (ahead[at - 1] if at else 0) + FRONTIER // 8)))
        query = np.arange(at, to)
        node, gathered, above = bucket[query], np.zeros(len(query), np.int64), np.zeros((len(query), values.shape[1]), np.uint64)
        for depth in range(len(levels) - 1, -1, -1):
            starts, pattern, shared, least, most = levels[depth]
            gathered = gathered + np.bitwise_count((values[query] ^ pattern[node]) & shared[node] & ~above).sum(axis=1, dtype=np.int64)
            near = (gathered <= limit) & ~((least[node] == most[node]) & (least[node] == group[query]))
            query, node, gathered = query[near], node[near], gathered[near]
            if depth:
                n = np.append(starts, len(levels[depth - 1][1]))[node + 1] - starts[node]
                above = np.repeat(shared[node], n, axis=0)
                child = np.repeat(starts[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                query, gathered, node = np.repeat(query, n), np.repeat(gathered, n), child
        once = node < query
        yield query[once], node[once], gathered[once]
        at = to


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels, each the first row of its group, with the groups of every pair joined."""
    label = label.copy()
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(nearer := label[label], label):
            label = nearer
    return label


def firsts(group: np.ndarray) -> np.ndarray:
    """For each row the first row of its group."""
    return np.unique(group, return_index=True, return_inverse=True)[1][np.unique(group, return_inverse=True)[1]]


def stars(values: np.ndarray, first: np.ndarray, limit: int) -> np.ndarray:
    """For each row the first row of its connected group in its bucket."""
    label = np.arange(len(values))
    for a, b, _ in pairs(values, first, limit):
        label = joined(label, a, b)
    return label


def lightest(a: np.ndarray, b: np.ndarray, weight: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Places of the pairs of a spanning forest of least weight over groups ``start``, by rounds in which each group takes its lightest pair."""
    order = np.lexsort((b, a, weight))
    a, b = a[order], b[order]
    label, alive, kept = start, np.arange(len(a)), []
    while True:
        x, y = label[a[alive]], label[b[alive]]
        apart = x != y
        alive, x, y = alive[apart], x[apart], y[apart]
        if not len(alive):
            return order[np.concatenate(kept)] if kept else order[:0]
        best = np.full(len(start), len(a))
        np.minimum.at(best, x, alive)
        np.minimum.at(best, y, alive)
        kept.append(np.unique(best[best < len(a)]))
        label = joined(label, a[kept[-1]], b[kept[-1]])


def forest(values: np.ndarray, first: np.ndarray, limit: int, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a spanning forest of least differences over the pairs within the limit, between groups if there are any."""
    start = np.arange(len(values))
    if group is not None:  # rows of a bucket are in order of their groups
        start = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]) | np.isin(start, first), start, 0))
    a, b, d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    label, heaviest = start, np.zeros(len(values), np.int64)
    for x, y, w in pairs(values, first, limit, start):
        new = (start[x] != start[y]) & ((label[x] != label[y]) | (w < heaviest[label[x]]))  # others close a circle as its heaviest pair
        if not new.any():
            continue
        a, b, d = np.concatenate([a, x[new]]), np.concatenate([b, y[new]]), np.concatenate([d, w[new]])
        kept = lightest(a, b, d, start)
        a, b, d = a[kept], b[kept], d[kept]
        label, heaviest = joined(start, a, b), np.zeros(len(values), np.int64)
        np.maximum.at(heaviest, label[a], d)
    return a, b


def _hash(*parts: np.ndarray) -> np.ndarray:
    """Mixed hash of columns of integers."""
    h = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        h = (h ^ p.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


class Hot:
    """Keys that are cut, in order, with the main group of each and the number of parts of other rows and of its own."""

    def __init__(self, rows: list) -> None:
        self.key, self.main, self.others, self.own = (np.array(c, np.int64) for c in (zip(*sorted(map(tuple, rows)), strict=True) if rows else [()] * 4))

    def _at(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.key, key), max(0, len(self.key) - 1))
        return at, (self.key[at] == key) if len(self.key) else np.zeros(len(key), bool)

    def parted(self, key: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Keys, those of hot ones by parts that don't meet."""
        at, hot = self._at(key)
        if hot.any():
            key = key.copy()
            k, n = at[hot], node[hot]
            key[hot] = _hash(key[hot], _hash(n).view(np.uint64) % (self.others[k] + self.own[k]).astype(np.uint64))
        return key

    def met(self, key: np.ndarray, node: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of hot keys and the meetings that they go to: each part of other rows meets each part."""
        at, hot = self._at(key)
        row = np.flatnonzero(hot)
        at, own = at[row], group[row] == self.main[at[row]]
        n = np.where(own, self.own[at], self.others[at])
        part = (_hash(node[row]).view(np.uint64) % np.maximum(n, 1).astype(np.uint64)).astype(np.int64) + np.where(own, self.others[at], 0)
        times = np.where(own, self.others[at], self.others[at] + self.own[at])
        back = np.repeat(np.arange(len(row)), times)
        other = np.arange(len(back)) - np.repeat(np.cumsum(times) - times, times)
        return row[back], _hash(key[row[back]], np.minimum(part[back], other), np.maximum(part[back], other))


def hot_keys(large: DataFrame, limit: int, groups: DataFrame | None = None) -> Hot:
    """How to cut keys (key, n), ``HOT_LIMIT`` at most: with ``groups`` (key, main, own, rows) those of several groups, by their main ones."""
    if groups is None:
        return Hot([(r["key"], -1, ceil(r["n"] / limit), 0) for r in large.collect()])
    share, part = F.col("own") / F.col("rows"), max(1, limit // 2)
    rows = large.join(groups, "key").filter("rows > own").select("key", "main", F.ceil(F.col("n") * (1 - share) / part), F.ceil(F.col("n") * share / part)).collect()
    return Hot([(k, main, max(1, others), max(1, own)) for k, main, others, own in rows])


def _largest(counts: DataFrame, limit: int) -> DataFrame:
    return cut_lineage(counts.filter(F.col("n") > limit).orderBy(F.desc("n"), "key").limit(HOT_LIMIT))


def main_groups(rows: DataFrame) -> DataFrame:
    """(key, main, own, rows): the largest group of each key with its number of rows, and that of all, from rows (key, comp)."""
    counted = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    return counted.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("m"), F.sum("n").alias("rows")).select("key", F.col("m.comp").alias("main"), F.col("m.n").alias("own"), "rows")


def _keys(fps: list[bytes], blocks: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints as rows of words, and for each row its key in each block."""
    wide = np.frombuffer(b"".join(fps), np.uint64).reshape(len(fps), WORDS)
    bits = np.unpackbits(wide.view(np.uint8), axis=1, bitorder="little")
    return wide, np.stack([bits[:, b] @ (np.int64(1) << np.arange(len(b), dtype=np.int64)) | (start + k) << 40 for k, b in enumerate(blocks)], axis=1)


def _dealt(fps: DataFrame, blocks: list[np.ndarray], start: int, to: object = None) -> DataFrame:
    """(key, node, comp, w0, …): every fingerprint once for each block; ``to`` gives places of rows (None: all) and their keys instead."""
    names = ["key", "node", "comp", *(f"w{w}" for w in range(COMPARED))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                wide, keys = _keys(batch.column(2).to_pylist(), blocks, start)
                node, comp = (np.repeat(batch.column(k).to_numpy(), keys.shape[1]) for k in range(2))
                key, row = keys.ravel(), np.repeat(np.arange(len(batch)), keys.shape[1])
                if to is not None:
                    taken, key = to(key, node, comp)
                    if taken is not None:
                        node, comp, row = node[taken], comp[taken], row[taken]
                for k in range(0, len(key), 20_480):
                    of = slice(k, k + 20_480)
                    yield pa.RecordBatch.from_arrays([pa.array(key[of]), pa.array(node[of]), pa.array(comp[of]), *(pa.array(wide[row[of], w].view(np.int64)) for w in range(COMPARED))], names=names)

    return fps.select("node", "comp", "fp").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _counted(fps: DataFrame, blocks: list[np.ndarray], start: int) -> DataFrame:
    """(key, n): how many fingerprints have a key, less those that are alone in a task, so that rare keys are not shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, waiting = [], [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            return key, np.bincount(at, np.concatenate(counts)).astype(np.int64)

        for batch in batches:
            for at in range(0, len(batch), 2048):
                key, n = np.unique(_keys(batch.column(0).slice(at, 2048).to_pylist(), blocks, start)[1], return_counts=True)
                keys.append(key)
                counts.append(n)
                waiting += len(key)
                if waiting > 2_000_000:
                    key, n = merged()
                    keys, counts, waiting = [key], [n], len(key) // 2
        if keys:
            key, n = merged()
            key, n = key[n > 1], n[n > 1]
            for k in range(0, len(key), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(key[k : k + 10_000]), pa.array(n[k : k + 10_000])], names=["key", "n"])

    return fps.select("fp").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _forests(rows: DataFrame, limit: int) -> DataFrame:
    """(a, b): the forests of rows (key, node, comp, w0, …) that have a key in common."""
    n = 3 + COMPARED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(rows: list[np.ndarray]) -> pa.RecordBatch:
            key, nodes, group = rows[:3]
            values = np.stack([r.view(np.uint64) for r in rows[3:n]], axis=1)
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(first, len(key)))
            several = np.repeat((size > 1) & (np.minimum.reduceat(group, first) != np.maximum.reduceat(group, first)), size)
            if not several.any():
                return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, names=["a", "b"])
            key, nodes, group, values = key[several], nodes[several], group[several], values[several]
            a, b = forest(values, np.flatnonzero(np.append(True, key[1:] != key[:-1])), limit, group)
            x, y = nodes[a], nodes[b]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            rows = [c.to_numpy() for c in batch.columns[:n]]
            if not len(rows[0]):
                continue
            held = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
            whole = int(np.searchsorted(held[0], held[0][-1]))  # the last bucket may go on
            if whole:
                yield solved([x[:whole] for x in held])
                held = [x[whole:] for x in held]
        if held is not None:
            yield solved(held)

    return rows.repartition("key").sortWithinPartitions("key", "comp", gray_rank(F.col("w0")), "node").mapInArrow(run, "a long, b long").distinct()


def near_copy_links(fps: DataFrame, blocks: list[np.ndarray], limit: int, start: int = 0) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b), a < b, within the limit among fingerprints (columns node, comp, fp): spanning forests of the buckets between
    groups ``comp``; and the buckets (key, n) that are cut into parts that don't meet."""
    large = _largest(_counted(fps, blocks, start), BUCKET_LIMIT)
    hot = hot_keys(large, BUCKET_LIMIT)
    parted = (lambda key, node, comp: (None, hot.parted(key, node))) if len(hot.key) else None
    return _forests(_dealt(fps, blocks, start, parted), limit), large


def links_of_large_buckets(fps: DataFrame, blocks: list[np.ndarray], limit: int, large: DataFrame) -> DataFrame | None:
    """The same for pairs that buckets ``large`` keep apart; None if none of them has several groups."""
    if large.isEmpty():
        return None
    there = np.array(sorted(r["key"] for r in large.select("key").collect()), np.int64)
    rows = _dealt(fps, blocks, 0, lambda key, node, comp: ((at := np.flatnonzero(np.isin(key, there))), key[at]))
    hot = hot_keys(large, BUCKET_LIMIT, main_groups(rows.select("key", "comp")))
    return _forests(_dealt(fps, blocks, 0, hot.met), limit) if len(hot.key) else None


def _mapped(rows: DataFrame, to: object) -> DataFrame:
    """Rows (key, node, comp, …) with other keys: ``to`` gives places of rows (None: all) and their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, key = to(*(batch.column(k).to_numpy() for k in range(3)))
            rest = batch.columns[1:] if at is None else [c.take(pa.array(at)) for c in batch.columns[1:]]
            for k in range(0, len(key), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(key[k : k + 10_000]), *(c.slice(k, 10_000) for c in rest)], names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def shingle_sets(members: DataFrame, fps: DataFrame, docs: DataFrame, shingle_words: int) -> DataFrame:
    """(key, node, comp, hashes) for every member (node, root): its group as key, itself as comp, its set of shingles as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t, shingle_words).tobytes() for t in texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), batch.column(0), pa.array(found, pa.binary())], names=["key", "node", "comp", "hashes"])

    keys = cut_lineage(members.join(fps.select("node", F.col("key").alias("of")), "node").select("of", "node", "root"))
    of_text = distinct_names(docs, "text").select(text_key(F.col("text")).alias("of"), "text").join(keys.select("of").hint("shuffle_hash"), "of", "left_semi").dropDuplicates(["of"])
    return keys.join(of_text, "of").select("node", "root", "text").mapInArrow(run, "key long, node long, comp long, hashes binary")


def exact_links(sets: list[np.ndarray], group: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows between groups that reach the similarity, enough to connect all that do."""
    sizes = np.array([len(s) for s in sets])
    there = np.flatnonzero(sizes)
    label, a, b = firsts(group), [], []
    if len(there) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ids = np.unique(np.concatenate([sets[k] for k in there]), return_inverse=True)[1]
    sizes, ends = sizes[there], np.cumsum(sizes[there])
    starts, flag = ends - sizes, np.zeros(ids.max() + 1, bool)
    names, count = np.unique(label[there], return_counts=True)
    main = names[count.argmax()] if count.max() > 1 else -1
    for x in np.flatnonzero(label[there] != main):
        apart = label[there] != label[there[x]]
        if not apart.any():
            continue
        own = ids[starts[x] : ends[x]]
        flag[own] = True
        both = np.add.reduceat(flag[ids], starts, dtype=np.int64)
        flag[own] = False
        near = apart & (both >= similarity * (sizes[x] + sizes - both))
        for y in np.flatnonzero(near):
            p, q = there[x], there[y]
            if label[p] != label[q]:
                a.append(p)
                b.append(q)
                label[label == max(label[p], label[q])] = min(label[p], label[q])
    return np.array(a, np.int64), np.array(b, np.int64)


def _exact(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs between groups of rows (key, node, comp, hashes) of a key that reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved(node: list, comp: list, sets: list) -> pa.RecordBatch:
            a, b = exact_links([np.frombuffer(x, np.uint64) for x in sets], np.array(comp, np.int64), similarity)
            x, y = np.array(node, np.int64)[a], np.array(node, np.int64)[b]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

        of, held = None, ([], [], [])
        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True):
                if key != of and held[0]:
                    yield solved(*held)
                    held = ([], [], [])
                of = key
                for column, value in zip(held, row, strict=True):
                    column.append(value)
        if held[0]:
            yield solved(*held)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long").distinct()


def _confirmed(links: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs of ``links`` whose sets of shingles reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                same.append(both >= similarity * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(same, pa.bool_()))

    one = links.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
    return one.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with comp set to what their nodes are connected to by ``links``."""
    found = components(links)
    return cut_lineage(rows.drop("comp").join(found, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root").select(*rows.columns))


def _with_roots(found: DataFrame) -> DataFrame:
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def candidates(fps: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) that connect all candidates among fingerprints (columns node, comp, fp; comp is the node)."""
    limit, blocks = bit_limit(similarity), block_plan(fps.count(), similarity)
    first, large = near_copy_links(fps, blocks[:FIRST_BLOCKS], limit)
    first = cut_lineage(first)
    second, others = near_copy_links(_labelled(fps, first), blocks[FIRST_BLOCKS:], limit, FIRST_BLOCKS)
    links = cut_lineage(first.unionByName(second))
    more = links_of_large_buckets(_labelled(fps, links), blocks, limit, large.unionByName(others))
    return links if more is None else cut_lineage(links.unionByName(more))


def copies(links: DataFrame, fps: DataFrame, docs: DataFrame, shingle_words: int, similarity: float) -> DataFrame:
    """Pairs (a, b) that connect all texts of the similarity among the groups of candidates that ``links`` connect."""
    members = cut_lineage(_with_roots(components(links)))
    sets = cut_lineage(shingle_sets(members, fps, docs, shingle_words))
    sizes = sets.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.length("hashes")).alias("bytes"))
    sizes = cut_lineage(sizes.select("key", F.greatest(F.col("n"), F.ceil(F.col("bytes") * MEETING / MEETING_BYTES)).alias("n")))
    large = _largest(sizes, MEETING)
    if large.isEmpty():
        return _exact(sets, similarity)
    small = _exact(sets.join(large.select("key"), "key", "left_anti"), similarity)
    rest = cut_lineage(sets.join(large.select("key"), "key", "left_semi"))
    good = cut_lineage(_confirmed(links.join(rest.select(F.col("node").alias("a")), "a", "left_semi"), rest, similarity))
    rest = _labelled(rest, good)
    hot = hot_keys(large, MEETING, main_groups(rest.select("key", "comp")))
    found = small.unionByName(good)
    return found.unionByName(_exact(_mapped(rest, hot.met), similarity)) if len(hot.key) else found


def near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, key, group, component_id) for every row: component_id is the least id reached over links of that similarity or more.

    ``key`` tells the texts of an id apart, ``group`` groups of the same component_id.
    """
    of_docs = cut_lineage(wide_fingerprints(docs, shingle_words))
    fps = of_docs.groupBy("fp", "shingles").agg(F.min("doc_id").alias("least"), F.min(F.struct(F.col("key_a").alias("a"), F.col("key_b").alias("b"))).alias("key"))
    fps = cut_lineage(fps.withColumn("node", F.monotonically_increasing_id()))
    links = candidates(fps.select("node", F.col("node").alias("comp"), "fp"), similarity)
    found = copies(links, fps, docs, shingle_words, similarity)
    members = _with_roots(components(found))
    members = cut_lineage(members.join(fps.select("node", "least"), "node"))
    least = cut_lineage(members.groupBy("root").agg(F.min("least").alias("component_id")))
    linked = cut_lineage(members.join(least, "root").select("node", "root", "component_id"))
    of_fp = cut_lineage(fps.join(linked, "node", "left").select("fp", "shingles", F.coalesce("root", "node").alias("group"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")))
    return of_docs.join(of_fp, ["fp", "shingles"]).select("doc_id", F.struct(F.col("key_a").alias("a"), F.col("key_b").alias("b")).alias("key"), "group", "component_id")
