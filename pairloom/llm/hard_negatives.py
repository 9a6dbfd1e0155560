"""Hard negatives by a multiway hyperplane tree whose leaves are searched exactly (operator 12).

Vectors become integers and get one more component that makes them equally long, so that an inner product with an anchor
is a distance and a window of scores an annulus around the anchor. A bounded sample gives the tree
(``hyperplane_tree.py``); every vector goes down to a leaf, and all of them give the ranges of distances, so that results
are exact and the sample affects speed alone. Neighbouring leaves are joined to cells and cells to slices, which are kept
as blocks of vectors; a large leaf is many slices. A search first asks each anchor's own cell, which narrows its windows to
what can be among the first, then all cells that a window's annulus may meet. An anchor goes to a slice once, with the set
of its cells there; a task holds one slice, and anchors, however many, pass through it in batches. What they find comes
back as a few bytes for each anchor and slice, and the first of all slices are chosen by anchor. Positives are one such
search among the same label, negatives another with a window for each positive among other labels.

Defined results: rows with a null id or label, or a null vector, or one with null or non-finite components, take no part;
shorter vectors count as filled up with zeros; very long ones are taken whole; ties go to the smaller id; an anchor
doesn't meet rows of its own id; repeated rows are rows each, also as anchors and positives; scores beyond 64 bits are held
at the largest or smallest long; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import ARROW_BATCH_BYTES, bound_batches, cut_lineage, distinct_names, read_table
from pairloom.llm.hyperplane_tree import Tree

SCALE, FIRST, LEAST, MOST = 256, 5, 80, 100
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
#: Vectors that a cell has at least, where there are so many; vectors in the sample at most, and their bytes, which bound the tree.
LEAF, SAMPLE, MAX_BYTES = 4096, 16_384, 32 << 20
#: Vectors of a block, of a slice; anchors that pass through a slice in one task, beyond which it is sent again.
BLOCK, SLICE, GROUP = 1024, 65_536, 262_144
#: Cells of a slice at most, as a set of them is a long; anchors that go down together, and that meet a block together; scores sifted at once.
CELLS, ASKING, TOGETHER, FLOOD = 62, 128, 512, 65_536
#: Vectors that go down the tree together.
DOWN = 16_384
#: Squared length below which integer vectors have exact products as floats, and components of two bytes.
SHORT = 2**24
_LOWEST, _HIGHEST = -(2**63), 2**63 - 1
_ASKED = "aid long, anchor_id long, label string, v binary, low binary, high binary, slices array<int>, cells array<long>"
_BLOCK = "slice int, cell long, ids binary, labels array<string>, v binary"
_RANGES = "node int, split int, kid int, near double, far double"
_FOUND = "aid long, found binary"


def _batch(rows: dict[str, list], shape: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.RecordBatch.from_arrays([pa.array(rows[c.split()[0]], kinds[c.split()[1]]) for c in shape.split(", ")], names=[c.split()[0] for c in shape.split(", ")])


def _values(column: pa.Array, kind: str) -> np.ndarray:
    """The values of all rows of a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _vectors(column: pa.Array, width: int, kind: str) -> np.ndarray:
    return _values(column, kind).reshape(len(column), width)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Larger batches, as a walk down the tree costs the least for each vector if many go together."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(map(len, waiting)) >= DOWN or sum(b.nbytes for b in waiting) >= ARROW_BATCH_BYTES:
            yield pa.concat_batches(waiting)
            waiting = []
    if waiting:
        yield pa.concat_batches(waiting)


def quantized(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label string, n components, square, v) of the rows that take part: v as integers of two bytes where the squared length is below ``SHORT``, else as doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, n = batch.column("v"), batch.column("v").value_lengths().to_numpy()
            x = v.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: nan
            row = np.repeat(np.arange(len(n)), n)
            sound = np.ones(len(n), bool)
            sound[row[~np.isfinite(x)]] = False
            kept, n = pa.array(sound), n[sound]
            x = x[sound[row]] * scale
            x = np.floor(x)
            square = np.bincount(np.repeat(np.arange(len(n)), n), x * x, len(n))
            short = square < SHORT
            if short.all():
                data = _joined(x.astype("i2"), n)
            else:
                ends = np.append(0, np.cumsum(n))
                data = pa.array([x[low:high].astype("i2" if s else "f8").tobytes() for low, high, s in zip(ends, ends[1:], short, strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(kept), batch.column("label").filter(kept), pa.array(n.astype(np.int32)), pa.array(square), data], names=["vec_id", "label", "n", "square", "v"])

    present = vectors.filter(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    return present.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").alias("v")).mapInArrow(run, "vec_id long, label string, n int, square double, v binary")


def _windows(low: pa.Array, high: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ends as (anchor, window) from longs as bytes; windows that an anchor doesn't have are empty."""
    n = pc.binary_length(low).to_numpy() // 8
    inside = np.arange(n.max(initial=0)) < n[:, None]
    ends = np.full(inside.shape, _HIGHEST), np.full(inside.shape, _LOWEST)
    for end, column in zip(ends, (low, high), strict=True):
        end[inside] = _values(column, "i8")
    return ends


def _joined(rows: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary for each count, with so many of the next rows."""
    ends = np.append(0, np.cumsum(counts) * (rows.nbytes // max(1, len(rows)))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(rows.tobytes())])


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors kept as floats of short vectors, or as doubles; beyond these, longs held to 64 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if a.dtype == np.float32 or float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return a @ b.T
    whole = [[[int(x) for x in row] for row in m] for m in (a, b)]
    return np.array([[max(_LOWEST, min(_HIGHEST, sum(x * y for x, y in zip(p, q, strict=True)))) for q in whole[1]] for p in whole[0]], np.int64)


class Index:
    """All vectors in slices, as a table of blocks, and the tree with the ranges of their distances."""

    def __init__(self, vectors: DataFrame) -> None:
        """``vectors``: as ``quantized`` gives them, stored."""
        count, self.width, longest = vectors.agg(F.count("*"), F.max("n"), F.max("square")).first()
        width = self.width = self.width or 1
        self.longest = longest = float(longest or 0)
        self.kind = kind = "i2" if longest < SHORT else "f8"
        taken = max(2, min(SAMPLE, MAX_BYTES // (8 * (width + 1))))
        # drawn row by row, as the first of an order would bring that many rows of each task to the driver
        drawn = vectors if count <= taken else vectors.filter(F.rand(1) < 0.95 * taken / count)
        sample = drawn.select("square", "v").toArrow()[:taken]
        self.tree = tree = Tree(self.equal(self.matrix(*(sample.column(c).combine_chunks() for c in ("square", "v")))), 3 * len(sample) * LEAF // max(count, 1))  # leaves hold a third of the most on average
        whole, equal = self.matrix, self.equal

        def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _gathered(batches):
                x = whole(batch.column("square"), batch.column("v"))
                leaf, _ = tree.down(equal(x))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(leaf.astype(np.int32)), _joined(x.astype(kind), np.ones(len(x), int))], names=["vec_id", "label", "leaf", "v"])

        self.rows = cut_lineage(vectors.select("vec_id", "label", "square", "v").mapInArrow(assigned, "vec_id long, label string, leaf int, v binary"))

        def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            near, far = ([np.full((len(s), len(s)), end) for s in tree.splits] for end in (np.inf, -np.inf))
            for batch in _gathered(batches):
                for node, kid, d in tree.down(equal(_vectors(batch.column("v"), width, kind).astype("f8")))[1]:
                    near[node][:, kid] = np.minimum(near[node][:, kid], d.min(0))
                    far[node][:, kid] = np.maximum(far[node][:, kid], d.max(0))
            met = [(np.full(int((low <= high).sum()), node), *np.nonzero(low <= high), low[low <= high], high[low <= high]) for node, (low, high) in enumerate(zip(near, far, strict=True))]
            yield _batch(dict(zip([c.split()[0] for c in _RANGES.split(", ")], map(np.concatenate, zip(*met, strict=True)), strict=True)), _RANGES)

        if tree.splits:  # rows for each node's pairs of split points, as many as the sample allows
            tree.near, tree.far = ([np.full((len(s), len(s)), end) for s in tree.splits] for end in (np.inf, -np.inf))
            for node, i, k, low, high in self.rows.select("v").mapInArrow(ranges, _RANGES).groupBy("node", "split", "kid").agg(F.min("near"), F.max("far")).collect():
                tree.near[node][i, k], tree.far[node][i, k] = low, high
        sizes = np.zeros(max(1, tree.leaves), np.int64)
        for leaf, n in self.rows.groupBy("leaf").count().collect():
            sizes[leaf] = n
        self._deal(sizes)

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.column("slice").to_numpy().astype(np.int64) * CELLS + batch.column("cell").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
                for low, high in zip(cuts, cuts[1:], strict=False):
                    for start in range(low, high, BLOCK):
                        some = batch.slice(start, min(BLOCK, high - start))
                        yield _batch({"slice": [int(at[low]) // CELLS], "cell": [int(at[low]) % CELLS], "ids": [some.column("vec_id").to_numpy().tobytes()], "labels": [some.column("label").to_pylist()], "v": [b"".join(some.column("v").to_pylist())]}, _BLOCK)

        # a row for each leaf, of which the sample allows so many
        places = self.rows.sparkSession.createDataFrame([(k, *map(int, p)) for k, p in enumerate(zip(self.slice_of, self.cell_of, self.slices_of, strict=True))], "leaf int, first int, cell int, slices int")
        dealt = self.rows.withColumn("n", F.monotonically_increasing_id()).join(F.broadcast(places), "leaf").withColumn("slice", (F.col("first") + F.pmod(F.xxhash64("n"), F.col("slices"))).cast("int"))
        dealt = dealt.select("vec_id", "label", "v", "slice", "cell").repartition("slice").sortWithinPartitions("slice", "cell")
        self.blocks = cut_lineage(dealt.mapInArrow(packed, _BLOCK))

    def _deal(self, sizes: np.ndarray) -> None:
        """For each leaf its first slice, its cell there and its number of slices; cells by number, with the first of each slice and leaf.

        Leaves in order fill a cell up to ``LEAF`` vectors and cells a slice up to ``SLICE``; a leaf beyond that is many
        slices of a cell each.
        """
        most = max(1, min(SLICE, MAX_BYTES // (8 * self.width)))
        self.slice_of, self.cell_of, self.slices_of, self.first_of = (np.zeros(len(sizes), np.int64) for _ in range(4))
        self.slice_starts: list[int] = []
        cells, full, in_cell, in_slice = 0, True, 0, 0  # ``full``: the next leaf starts a slice
        for leaf, n in enumerate(sizes.tolist()):
            parts = -(-n // most)
            if parts > 1:
                self.slice_of[leaf], self.slices_of[leaf], self.first_of[leaf] = len(self.slice_starts), parts, cells
                self.slice_starts += range(cells, cells + parts)
                cells, full = cells + parts, True
                continue
            if full or in_slice + n > most or (in_cell >= LEAF and cells - self.slice_starts[-1] == CELLS):
                self.slice_starts.append(cells)
                cells, in_cell, in_slice, full = cells + 1, 0, 0, False
            elif in_cell >= LEAF:
                cells, in_cell = cells + 1, 0
            in_cell, in_slice = in_cell + n, in_slice + n
            self.slice_of[leaf], self.cell_of[leaf], self.slices_of[leaf], self.first_of[leaf] = len(self.slice_starts) - 1, cells - 1 - self.slice_starts[-1], 1, cells - 1
        self.cells = cells

    @property
    def matrix(self) -> Callable[[pa.Array, pa.Array], np.ndarray]:
        """Vectors, as ``quantized`` gives them, filled up with zeros."""
        width = self.width

        def made(square: pa.Array, v: pa.Array) -> np.ndarray:
            m, short = np.zeros((len(v), width)), square.to_numpy() < SHORT
            n = pc.binary_length(v).to_numpy() // np.where(short, 2, 8)
            for some, kind in ((short, "i2"), (~short, "f8")):
                m[(np.arange(width) < n[:, None]) & some[:, None]] = _values(v.filter(pa.array(some)), kind)
            return m

        return made

    @property
    def equal(self) -> Callable[[np.ndarray], np.ndarray]:
        """Adds the component that makes all vectors as long as the longest."""
        longest = self.longest
        return lambda x: np.hstack([x, np.sqrt(np.maximum(0, longest - (x * x).sum(1, keepdims=True)))])

    def search(self, anchors: DataFrame, k: int, same: bool) -> DataFrame:
        """(aid, window, vec_id, score, rank): the ``k`` first of each window of each anchor, among its label or the others.

        ``anchors``: aid, anchor_id, label, leaf, v, low and high, arrays with an element for each window.
        """
        anchors = anchors.select("leaf", "aid", "anchor_id", "label", "v", "low", "high")
        seen = self._found(self._asked(anchors, True), k, same)
        # what the own cell holds narrows the windows
        least = seen.filter(F.col("rank") == k).groupBy("aid").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("least"))
        raised = F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.element_at("least", (i + 1).cast("int")), x)))
        narrowed = anchors.join(least, "aid", "left").withColumn("low", F.when(F.col("least").isNull(), F.col("low")).otherwise(raised)).drop("least")
        return self._found(self._asked(narrowed, False), k, same)

    def _asked(self, anchors: DataFrame, own_cell: bool) -> DataFrame:
        """The slices that each anchor asks, and of each the set of cells."""
        tree, width, longest, kind, cells = self.tree, self.width, self.longest, self.kind, self.cells
        first_of, slices_of, starts = self.first_of, self.slices_of, np.array(self.slice_starts, int)
        bit = np.left_shift(np.int64(1), np.arange(cells) - np.repeat(starts, np.diff([*starts, cells])))

        def reached(batch: pa.RecordBatch, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
            """(anchor, cell): whether it is asked."""
            asked = np.zeros((len(batch), cells), bool)
            if own_cell:  # of a leaf of many slices, the first
                asked[np.arange(len(batch)), first_of[batch.column("leaf").to_numpy()]] = True
                return asked
            x = _vectors(batch.column("v"), width, kind).astype("f8")
            low, high = lows.astype("f8"), highs.astype("f8")
            square = (x * x).sum(1, keepdims=True)
            total = square + longest
            # distance² = |anchor|² + longest² - 2 score; scores at the ends of 64 bits may be beyond them
            near = np.where(high >= float(_HIGHEST), 0, np.sqrt(np.maximum(0, total - 2 * high)))
            far = np.where(low <= float(_LOWEST), np.inf, np.sqrt(np.maximum(0, total - 2 * low)))
            empty = lows > highs
            near[empty], far[empty] = np.inf, -1
            slack = 1e-6 * (1 + np.sqrt(total[:, 0]))
            if near.shape[1] > 1:  # annuli with a distance in common are one
                inner, outer = np.where(empty, np.inf, near).min(1), np.where(empty, -1, far).max(1)
                one = np.where(empty, 0, near).max(1) <= np.where(empty, np.inf, far).min(1)
                near[one], far[one] = np.inf, -1
                near[one, 0], far[one, 0] = inner[one], outer[one]
            of, leaves = tree.reached(np.hstack([x, np.zeros((len(x), 1))]), near, far, slack)
            n = slices_of[leaves]
            asked[np.repeat(of, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first_of[leaves], n)] = True
            return asked

        def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, len(whole), ASKING):
                    batch = whole.slice(at, ASKING)
                    lows, highs = (_joined(batch.column(c).flatten().to_numpy(), batch.column(c).value_lengths().to_numpy()) for c in ("low", "high"))
                    sets = np.add.reduceat(reached(batch, *_windows(lows, highs)) * bit, starts, axis=1)
                    of, slices = np.nonzero(sets)
                    ends = pa.array(np.searchsorted(of, np.arange(len(batch) + 1)).astype(np.int32))
                    lists = [pa.ListArray.from_arrays(ends, pa.array(a)) for a in (slices.astype(np.int32), sets[of, slices])]
                    yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("aid", "anchor_id", "label", "v")), lows, highs, *lists], names=[c.split()[0] for c in _ASKED.split(", ")])

        return cut_lineage(anchors.mapInArrow(asked, _ASKED))

    def _found(self, asked: DataFrame, k: int, same: bool) -> DataFrame:
        width, kind, key = self.width, self.kind, ["slice", "part"]
        pairs = asked.select("*", F.explode(F.arrays_zip("slices", "cells")).alias("to")).select("aid", "anchor_id", "label", "v", "low", "high", F.col("to.slices").alias("slice"), F.col("to.cells").alias("cell"))
        parts = F.broadcast(pairs.groupBy("slice").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts")))  # a row for each slice
        sent = self.blocks.join(parts, "slice").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        asking = pairs.join(parts, "slice").withColumn("part", F.pmod(F.xxhash64("aid"), F.col("parts")).cast("int")).drop("parts")
        rows = sent.unionByName(asking, allowMissingColumns=True)

        def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of, blocks, held = None, [], None
            for batch in batches:
                at = np.stack([batch.column("slice").to_numpy(), batch.column("part").to_numpy(), batch.column("ids").is_null().to_numpy(zero_copy_only=False)])
                cuts = [0, *(np.flatnonzero(np.diff(at).any(0)) + 1).tolist(), at.shape[1]]
                for low, high in zip(cuts, cuts[1:], strict=False):
                    some = batch.slice(low, high - low)
                    if (now := tuple(at[:2, low])) != of:
                        of, blocks, held = now, [], None
                    if not at[2, low]:
                        blocks.append(some.select(["cell", "ids", "labels", "v"]))
                        continue
                    if blocks:
                        held, blocks = Slice(blocks, width, kind, k, same), []
                    for start in range(0, len(some) if held else 0, TOGETHER):
                        yield held.first(some.slice(start, TOGETHER))

        # blocks, then anchors, by label where only those of the same label meet
        found = rows.repartition(*key).sortWithinPartitions(*key, F.col("ids").isNull(), *(["label"] if same else [])).mapInArrow(searched, _FOUND)

        def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The first of all slices; an anchor's windows come before what it has found, and it may go on in the next batch."""
            rest: list[pa.RecordBatch] = []
            for batch in batches:
                aids = batch.column("aid").to_numpy()
                if not len(aids):
                    continue
                if rest and rest[0].column("aid")[0].as_py() != aids[0]:
                    yield first(rest)
                    rest = []
                cut = int(np.searchsorted(aids, aids[-1]))
                if cut:
                    yield first([*rest, batch.slice(0, cut)])
                    rest = []
                rest.append(batch.slice(cut))
            if rest:
                yield first(rest)

        def first(some: list[pa.RecordBatch]) -> pa.RecordBatch:
            aids, low, high, found = (pa.concat_arrays([b.column(c) for b in some]) for c in ("aid", "low", "high", "found"))
            heads = found.is_null().to_numpy(zero_copy_only=False)
            low, high = _windows(low.filter(pa.array(heads)), high.filter(pa.array(heads)))
            pieces = found.drop_null()
            ids, s = _values(pieces, "i8").reshape(-1, 2).T
            of = np.repeat((np.cumsum(heads) - 1)[~heads], pc.binary_length(pieces).to_numpy() // 16)
            c, w = np.nonzero((s[:, None] >= low[of]) & (s[:, None] <= high[of]))
            of, ids, s = of[c], ids[c], s[c]
            ranked = np.lexsort((ids, ~s, w, of))  # ~s orders as -s does, without overflow
            of, w, ids, s = (x[ranked] for x in (of, w, ids, s))
            window = of * max(1, low.shape[1]) + w
            rank = np.arange(len(of)) - np.searchsorted(window, window)
            of, w, ids, s, rank = (x[rank < k] for x in (of, w, ids, s, rank))
            return _batch({"aid": aids.to_numpy()[heads][of], "window": w + 1, "vec_id": ids, "score": s, "rank": rank + 1}, shape)

        shape = "aid long, window int, vec_id long, score long, rank int"
        all_ = asked.select("aid", "low", "high").unionByName(found, allowMissingColumns=True)
        return cut_lineage(all_.repartition("aid").sortWithinPartitions("aid", F.col("found").isNotNull()).mapInArrow(merged, shape))


class Slice:
    """A slice's vectors, which batches of anchors pass through."""

    def __init__(self, blocks: list[pa.RecordBatch], width: int, kind: str, k: int, same: bool) -> None:
        self.width, self.kind, self.k, self.same = width, kind, k, same
        ids, labels, cells, v = (pa.concat_arrays([b.column(c) for b in blocks]) for c in ("ids", "labels", "cell", "v"))
        named = labels.flatten().dictionary_encode()
        self.names, codes = named.dictionary, named.indices.to_numpy().astype(np.int64)
        cells = np.repeat(cells.to_numpy(), labels.value_lengths().to_numpy())
        ids = _values(ids, "i8")
        # runs are met together, of a label or else of a cell; ids rise within them, so that ties are rarely replaced
        run = codes if same else cells
        order = np.lexsort((ids, run))
        self.ids, self.codes = ids[order], codes[order]
        self.runs, starts = np.unique(run[order], return_index=True)
        self.ends = np.append(starts, len(order))
        self.x = self.floats(_values(v, kind).reshape(-1, width)[order])

    def floats(self, x: np.ndarray) -> np.ndarray:
        return x.astype("f4" if self.kind == "i2" else "f8")

    def first(self, anchors: pa.RecordBatch) -> pa.RecordBatch:
        """For each anchor what may be among the first of one of its windows, as ids and scores."""
        self.mine, self.own = pc.index_in(anchors.column("label"), value_set=self.names).fill_null(-1).to_numpy().astype(np.int64), anchors.column("anchor_id").to_numpy()
        self.low, self.high = _windows(anchors.column("low"), anchors.column("high"))
        #: The largest id that a tie with a window's lower end may have.
        self.tied = np.full(self.low.shape, _HIGHEST)
        self.found, self.waiting = (np.zeros(0, np.int64),) * 3, []
        self._settle()
        v, cells = self.floats(_vectors(anchors.column("v"), self.width, self.kind)), anchors.column("cell").to_numpy()
        live = (self.low <= self.high).any(1)
        for run, start, end in zip(self.runs.tolist(), self.ends.tolist(), self.ends[1:].tolist(), strict=False):
            rows = np.flatnonzero(live & (self.mine == run if self.same else (cells >> run) & 1 == 1))
            some, step = v[rows], BLOCK * TOGETHER // max(1, len(rows))
            for at in range(start, end if len(rows) else start, step):
                self._meet(rows, at, scores(some, self.x[at : min(at + step, end)]))
        self._settle()
        q, c, s = self.found
        key, one = np.unique(q // max(1, self.low.shape[1]) * len(self.ids) + c, return_index=True)
        rows, counts = np.unique(key // len(self.ids), return_counts=True)
        return pa.RecordBatch.from_arrays([anchors.column("aid").take(pa.array(rows)), _joined(np.stack([self.ids[c[one]], s[one]], 1), counts)], names=["aid", "found"])

    def _meet(self, rows: np.ndarray, at: int, s: np.ndarray) -> None:
        """Scores of anchors with the vectors from ``at``."""
        least = self.least[rows]
        if s.dtype.kind == "f":  # all scores are below these
            least = np.clip(least, *((-SHORT, SHORT) if s.dtype == np.float32 else (-(2**53), 2**53))).astype(s.dtype)
        hot = np.flatnonzero(s.max(1) >= least)
        if not len(hot):
            return
        near = s[hot] >= least[hot, None]
        if np.count_nonzero(near) <= FLOOD:
            r, c = np.nonzero(near)
            self._keep(rows[hot[r]], at + c, s[hot[r], c].astype(np.int64))
            return
        step = max(1, FLOOD // len(rows))
        for start in range(0, s.shape[1], step):
            some, ids, codes = s[:, start : start + step].astype(np.int64), *(x[at + start : at + start + step][: s.shape[1] - start] for x in (self.ids, self.codes))
            fits = np.zeros(some.shape, bool)
            for low, high, tied in zip(self.low[rows].T, self.high[rows].T, self.tied[rows].T, strict=True):
                fits |= (some >= low[:, None]) & (some <= high[:, None]) & ((some > low[:, None]) | (ids <= tied[:, None]))
            r, c = np.nonzero(fits & ((codes == self.mine[rows, None]) == self.same))
            self._keep(rows[r], at + start + c, some[r, c])

    def _keep(self, rows: np.ndarray, columns: np.ndarray, s: np.ndarray) -> None:
        fits = ((self.codes[columns] == self.mine[rows]) == self.same) & (self.ids[columns] != self.own[rows])
        rows, columns, s = rows[fits], columns[fits], s[fits]
        low, ids = self.low[rows], self.ids[columns]
        n, w = np.nonzero((s[:, None] >= low) & (s[:, None] <= self.high[rows]) & ((s[:, None] > low) | (ids[:, None] <= self.tied[rows])))
        self.waiting.append((rows[n] * low.shape[1] + w, columns[n], s[n]))
        if sum(len(x[0]) for x in self.waiting) > 2 * self.low.size:
            self._settle()

    def _settle(self) -> None:
        """The first of each window of what was found, which raise its lower end."""
        q, c, s = (np.concatenate(p) for p in zip(self.found, *self.waiting, strict=True))
        ranked = np.lexsort((self.ids[c], ~s, q))  # ~s orders as -s does, without overflow
        q, c, s = q[ranked], c[ranked], s[ranked]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        q, c, s, rank = (x[rank < self.k] for x in (q, c, s, rank))
        last = rank == self.k - 1
        self.low.flat[q[last]], self.tied.flat[q[last]] = s[last], self.ids[c[last]]
        self.found, self.waiting = (q, c, s), []
        self.least = np.where(self.low <= self.high, self.low, _HIGHEST).min(1, initial=_HIGHEST)


def hard_negatives(vectors: DataFrame, is_anchor: Column, first: int = FIRST, least: int = LEAST, most: int = MOST, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows (vec_id, embedding, label) whose vec_id meets ``is_anchor``.

    A negative's score is from ``least`` to ``most`` hundredths of the positive's.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    rows = cut_lineage(quantized(distinct_names(vectors, "vec_id", "embedding", "label"), scale))
    index = Index(rows)
    anchors = index.rows.filter(is_anchor).withColumnRenamed("vec_id", "anchor_id").withColumn("aid", F.monotonically_increasing_id())
    anchors = cut_lineage(anchors)
    ends = {c: F.array(F.lit(e).cast("long")) for c, e in (("low", _LOWEST), ("high", _HIGHEST))}
    positives = index.search(anchors.withColumns(ends), first, True).select("aid", F.col("rank").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    score = F.col("positive_score").cast("decimal(38,0)")
    low, high = (F.least(F.greatest(x, F.lit(_LOWEST).cast("decimal(38,0)")), F.lit(_HIGHEST).cast("decimal(38,0)")).cast("long") for x in (F.ceil(score * least / 100), F.floor(score * most / 100)))
    windows = positives.select("aid", "window", low.alias("low"), high.alias("high")).groupBy("aid").agg(F.sort_array(F.collect_list(F.struct("window", "low", "high"))).alias("w"))  # ``first`` at most
    asked = anchors.join(windows.select("aid", F.col("w.low").alias("low"), F.col("w.high").alias("high")), "aid")
    negatives = index.search(asked, first, False).select("aid", "window", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return negatives.join(positives, ["aid", "window"]).join(anchors.select("aid", "anchor_id"), "aid").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five hardest negatives for each of the five positives of every hundredth vector, after some labels were changed."""
    vectors = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % ANCHOR_EVERY == 0)
