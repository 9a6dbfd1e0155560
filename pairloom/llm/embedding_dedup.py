"""Exact near-duplicate vectors within a label by cover trees (operator 11).

Vectors that are equal count once, with their number. A cover tree over a bounded sample gives cells: a vector belongs to
the cell whose centre it reaches by the nearest centre of each level. The farthest vector of each cell bounds the nodes
above, so that a vector goes down the tree only where links can be, and meets

* nodes beyond the limit even at their nearest point: pruned, with all cells below;
* nodes within it even at their farthest, and narrower than it: all their vectors link, which takes their number and one
  edge to their least id, no pairs;
* other cells: it visits them.

A cell meets its visitors in blocks of its own vectors. There a cover tree of the block and one of a batch of visitors are
traversed together (``cover_tree.py``), and edges lead from each vector to one vector of its group. A hot cell is many
blocks, and a group of near copies is met by its number; so no task holds more than a block and a batch, and no pairs
within a group are emitted. Components of the edges give the classes. Results are exact: the sample affects speed alone.

Defined results: a vector that is null, empty, zero or holds null or non-finite components links with nothing and is a
class of itself, as is one of a null label; shorter vectors count as filled up with zeros; very long ones are taken whole;
repeated rows are vectors each, and copies of each other; rows of one id share their class; a row of a null id takes no
part: no links, a null class, kept; an empty table gives an empty result. Ties can't be. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import bound_batches, cut_lineage, distinct_names, read_table
from pairloom.llm.components import components
from pairloom.llm.cover_tree import MARGIN, CoverTree, Groups, Links, distances

LEAST_COSINE = 0.93
#: Vectors that a cell aims at; cells at most, and bytes of their centres, which every task gets.
CELL = 4096
MAX_CELLS, MAX_BYTES = 16_384, 32 << 20
#: Vectors of a block of a cell; visitors of a batch.
BLOCK, BATCH = 16_384, 4096


def unit(rows: list, width: int) -> np.ndarray:
    m = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        m[k, : len(r)] = r
    m /= np.maximum(np.abs(m).max(1, initial=0, keepdims=True), 1e-300)
    return m / np.maximum(np.sqrt((m * m).sum(1, keepdims=True)), 1e-300)


class Cells:
    """The sampled vectors of a label, a cell each, under a cover tree; once known, the bounds of all vectors in them."""

    def __init__(self, first: int, points: np.ndarray) -> None:
        self.first, self.tree = first, CoverTree(points)

    def bound(self, radii: np.ndarray, sizes: np.ndarray, least: np.ndarray) -> None:
        t = self.tree
        self.radii, self.sizes, self.least = radii, sizes, least
        self.cover, self.total, self.head = np.zeros(len(t.center)), np.zeros(len(t.center), np.int64), np.zeros(len(t.center), np.int64)
        for node in range(len(t.center)):
            mine = t.members(node)
            held = mine[sizes[mine] > 0]
            if len(held):
                self.cover[node] = (distances(t.points[t.center[[node]]], t.points[held])[0] + radii[held]).max()
                self.total[node], self.head[node] = sizes[held].sum(), least[held].min()

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector, and how far its centre is."""
        t, cell, far = self.tree, np.zeros(len(x), int), np.zeros(len(x))
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if t.first[node] == t.last[node]:
                mine = t.members(node)
                d = distances(x[rows], t.points[mine])
                at = d.argmin(1)
                cell[rows], far[rows] = mine[at], d[np.arange(len(rows)), at]
                continue
            under = t.below(node)
            at = distances(x[rows], t.points[t.center[under]]).argmin(1)
            ranked = np.argsort(at, kind="stable")
            kids, starts = np.unique(at[ranked], return_index=True)
            todo += zip(under[kids].tolist(), np.split(rows[ranked], starts[1:]), strict=True)
        return cell, far

    def visits(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, int]]]:
        """(rows, cells) to visit; for each row how many vectors link as a whole; and (rows, least id) of those."""
        t, rows_of, cells_of, more, whole = self.tree, [], [], np.zeros(len(x), np.int64), []
        todo = [(0, np.arange(len(x)))]

        def judged(rows: np.ndarray, centers: np.ndarray, cover: np.ndarray, total: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            d = distances(x[rows], centers)
            open_ = (d <= reach + cover + MARGIN) & (total > 0)
            all_ = (d + cover < reach - MARGIN) & (2 * cover < reach - 3 * MARGIN) & (total > 0)  # if so for one of its own vectors, then for all
            more[rows] += all_ @ total
            whole.extend((rows[all_[:, k]], int(head[k])) for k in np.flatnonzero(all_.any(0)))
            return np.nonzero((open_ & ~all_).T)[::-1]

        while todo:
            node, rows = todo.pop()
            if t.first[node] == t.last[node]:
                mine = t.members(node)
                i, k = judged(rows, t.points[mine], self.radii[mine], self.sizes[mine], self.least[mine])
                rows_of.append(rows[i])
                cells_of.append(mine[k])
            else:
                under = t.below(node)
                i, k = judged(rows, t.points[t.center[under]], self.cover[under], self.total[under], self.head[under])
                kids, starts = np.unique(k, return_index=True)
                todo += zip(under[kids].tolist(), np.split(rows[i], starts[1:]), strict=True)
        none = [np.zeros(0, int)]
        return np.concatenate(rows_of or none), np.concatenate(cells_of or none), more, whole


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The rows of each label of each batch."""
    for batch in batches:
        labels = np.array(batch.column("label").to_pylist(), object)
        for label in dict.fromkeys(labels):
            yield label, batch.take(pa.array(np.flatnonzero(labels == label)))


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), width)


def links(vectors: DataFrame, least: float = LEAST_COSINE) -> tuple[DataFrame, DataFrame]:
    """(gid, n_links) and edges (a, b) of ids, for distinct vectors (gid, vec_id, label, v array of doubles, n)."""
    spark = vectors.sparkSession
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 1
    reach = float(np.sqrt(max(0.0, 2 - 2 * least)))
    count = vectors.count()
    cells = max(1, min(MAX_CELLS, MAX_BYTES // (8 * width), -(-count // CELL)))
    sample = vectors.select(F.xxhash64("gid").alias("h"), "gid", "label", "v").orderBy("h", "gid").limit(cells).collect()
    by_label: dict[str, list] = {}
    for row in sample:
        by_label.setdefault(row["label"], []).append(row["v"])
    parts: dict[str, Cells] = {}
    for label, rows in by_label.items():
        parts[label] = Cells(sum(len(p.tree.points) for p in parts.values()), unit(rows, width))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, batch in _labelled(batches):
            x = unit(batch.column("v").to_pylist(), width)
            if label in parts:
                cell, far = parts[label].home(x)
                cell = cell + parts[label].first
            else:
                cell, far = np.full(len(x), -1), np.zeros(len(x))
            made = [batch.column("label"), pa.array(cell.astype(np.int32)), pa.array(far), *(batch.column(c) for c in ("gid", "vec_id", "n")), pa.array([r.tobytes() for r in x], pa.binary())]
            yield pa.RecordBatch.from_arrays(made, names=["label", "cell", "far", "gid", "vec_id", "n", "v"])

    homes = cut_lineage(vectors.select("label", "gid", "vec_id", "n", "v").mapInArrow(assigned, "label string, cell int, far double, gid long, vec_id long, n long, v binary"))
    radii, sizes, heads, rows = np.zeros(cells), np.zeros(cells, np.int64), np.zeros(cells, np.int64), np.zeros(cells, np.int64)
    for cell, *stats in homes.filter("cell >= 0").groupBy("cell").agg(F.max("far"), F.sum("n"), F.min("vec_id"), F.count("*")).collect():  # a row for each cell
        radii[cell], sizes[cell], heads[cell], rows[cell] = stats
    for part in parts.values():
        mine = slice(part.first, part.first + len(part.tree.points))
        part.bound(radii[mine], sizes[mine], heads[mine])
    blocks = -(-rows // BLOCK)
    fields = [("label", pa.string()), ("cell", pa.int32()), ("blocks", pa.int32()), ("home", pa.bool_()), ("gid", pa.int64()), ("vec_id", pa.int64()), ("n", pa.int64()), ("v", pa.binary()), ("whole", pa.bool_()), ("more", pa.int64()), ("heads", pa.list_(pa.int64()))]
    columns = [name for name, _ in fields]

    def visiting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for label, batch in _labelled(batches):
            own = batch.column("cell").to_numpy()
            if label not in parts:
                rows_of, cells_of, more, heads_of, alone = np.arange(len(batch)), own, np.zeros(len(batch), np.int64), [[]] * len(batch), np.zeros(len(batch), bool)
            else:
                part, x = parts[label], _vectors(batch.column("v"), width)
                at, to, more, whole = part.visits(x, reach)
                weight = batch.column("n").to_numpy()
                mine = own - part.first
                heads_of = [[] for _ in range(len(x))]
                for some, head in whole:
                    for r in some.tolist():
                        heads_of[r].append(head)
                away = to != mine[at]
                alone = np.ones(len(x), bool)  # its own cell was taken whole, itself too
                alone[at[~away]] = False
                more = more - np.where(alone, weight, 0)
                rows_of = np.concatenate([np.arange(len(x)), at[away]])
                cells_of = np.concatenate([own, to[away] + part.first])
            home = np.arange(len(rows_of)) < len(batch)
            of = pa.array(rows_of)
            made = {"label": batch.column("label").take(of), "cell": pa.array(cells_of.astype(np.int32)), "home": pa.array(home), **{c: batch.column(c).take(of) for c in ("gid", "vec_id", "n", "v")}}
            made["blocks"] = pa.array(np.where(cells_of >= 0, blocks[cells_of], 0).astype(np.int32))
            made["whole"] = pa.array(home & alone[rows_of])
            made["more"] = pa.array(np.where(home, more[rows_of], 0))
            made["heads"] = pa.array([heads_of[r] if h else [] for r, h in zip(rows_of.tolist(), home.tolist(), strict=True)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([made[c].cast(kind) for c, kind in fields], names=columns)

    met = cut_lineage(homes.select("label", "cell", "gid", "vec_id", "n", "v").mapInArrow(visiting, "label string, cell int, blocks int, home boolean, gid long, vec_id long, n long, v binary, whole boolean, more long, heads array<long>"))
    # labels without a sampled vector are a cell each, of as many blocks as they need
    alone = homes.filter("cell < 0").groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("needed"))
    units = met.filter("cell >= 0").unionByName(met.filter("cell < 0").join(alone, "label").withColumn("blocks", F.col("needed")).drop("needed"))
    own = F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int")
    units = units.withColumn("own", own).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.filter(~F.col("whole") | (F.col("block") == F.col("own")))
    units = units.select("label", "cell", "block", (F.col("home") & (F.col("block") == F.col("own"))).alias("home"), "whole", "gid", "vec_id", "n", "v")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's vectors first, then its visitors in batches."""
        of, block, waiting, size = None, None, [], 0

        def made(gids: np.ndarray, found: np.ndarray, ids: np.ndarray, heads: np.ndarray) -> pa.RecordBatch:
            kept = (found > 0) | (ids != heads)
            return pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (gids, found, ids, heads)], names=["gid", "n_links", "a", "b"])

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal block, waiting, size
            if waiting:
                gids, ids, n = (np.concatenate([b.column(c).to_numpy() for b in waiting]) for c in ("gid", "vec_id", "n"))
                x = np.concatenate([_vectors(b.column("v"), width) for b in waiting])
                tree = CoverTree(x)
                if block is None:
                    whole = waiting[0].column("whole")[0].as_py()  # all of the cell or none; counted already
                    inner = None if whole else Links(tree, n, None, least)
                    block = (tree, gids, ids, n, *((inner.groups.root, inner.found) if inner else np.zeros((2, len(ids)), np.int64)))
                else:
                    home, _, home_ids, home_n, root, _ = block
                    groups = Groups(len(home_ids) + len(ids))
                    groups.root[: len(home_ids)] = root
                    outer = Links(home, home_n, tree, least, groups)
                    root[:] = groups.root[: len(home_ids)]
                    to = groups.root[len(home_ids) :]
                    yield made(gids, outer.found, ids, np.where(to < len(home_ids), home_ids[np.minimum(to, len(home_ids) - 1)], ids))
            waiting, size = [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal block
            yield from flush()
            if block is not None:
                _, gids, ids, _, root, found = block
                yield made(gids, found, ids, ids[root])
            block = None

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "cell", "block", "home")), strict=True))
            start = 0
            for end in range(1, len(keys) + 1):
                if end == len(keys) or keys[end] != keys[start]:
                    *key, home = keys[start]
                    if key != of:
                        yield from close()
                        of = key
                    if not home and block is None:
                        yield from flush()
                    for at in range(start, end, BATCH) if home or block is not None else ():
                        waiting.append(some := batch.slice(at, min(BATCH, end - at)))
                        size += len(some)
                        if not home and size >= BATCH:
                            yield from flush()
                    start = end
        yield from close()

    key = ["label", "cell", "block"]
    found = cut_lineage(units.repartition(*key).sortWithinPartitions(*key, F.desc("home")).mapInArrow(compared, "gid long, n_links long, a long, b long"))
    counts = met.filter("home").select("gid", F.col("more").alias("n_links")).unionByName(found.select("gid", "n_links")).groupBy("gid").agg(F.sum("n_links").alias("n_links"))
    edges = met.filter("home").select(F.col("vec_id").alias("a"), F.explode("heads").alias("b")).unionByName(found.select("a", "b")).filter("a <> b")
    return counts, edges


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: other vectors of its label with a cosine of ``least`` or more."""
    spark = vectors.sparkSession
    bound_batches(spark)
    v = F.col(f"`{vector_column}`")
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))) & F.exists(v, lambda x: x != 0)
    takes_part = sound & F.col(f"`{id_column}`").isNotNull() & F.col(f"`{label_column}`").isNotNull()
    rows = distinct_names(vectors, id_column, vector_column, label_column)
    rows = rows.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.when(takes_part, F.col(f"`{label_column}`").cast("string")).alias("label"), F.when(takes_part, v.cast("array<double>")).alias("v"))
    copies = rows.filter("v IS NOT NULL").groupBy("label", "v").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n"))
    copies = cut_lineage(copies.withColumn("gid", F.monotonically_increasing_id()))
    counts, edges = links(copies, least)
    # rows of one id are one node, whatever their vectors
    shared = rows.filter("v IS NOT NULL").join(copies.select("label", "v", F.col("vec_id").alias("head"), "n", "gid"), ["label", "v"])
    shared = cut_lineage(shared.select("vec_id", "head", "n", "gid"))
    roots = components(edges.unionByName(shared.filter("vec_id <> head").select(F.col("vec_id").alias("a"), F.col("head").alias("b"))))
    found = shared.join(counts, "gid", "left").select("vec_id", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    found = found.unionByName(rows.filter("v IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links")))
    found = found.join(roots, F.col("vec_id") == F.col("node"), "left").select("vec_id", "n_links", F.coalesce("root", "vec_id").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, class and verdict of every vector."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
