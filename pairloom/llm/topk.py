"""Exact inner-product search over norm-sorted blocks (operator 6).

Vectors become integers; candidates are dealt by descending length into ranges and packed into blocks. Vectors are also
rotated by the right singular vectors of a bounded sample, so that their leading components carry most of a product
(any rotation keeps products, so the sample affects speed alone). Each query first meets the longest block, which
bounds its k-th best score from below. Queries go in groups to the ranges whose longest vector can reach that, and of a
range only those blocks go to a group that can reach the bound of one of its queries. There blocks are taken by
descending length and the bounds rise from block to block: candidates are dropped by Cauchy-Schwarz, as the partial sum
over the leading components plus the product of the residual lengths bounds the score. What is left is scored exactly
in integers. A group gives at most k rows for each of its queries and range.

Defined results: a vector that is null, or holds null or non-finite components, takes no part; shorter vectors count
as filled up with zeros; ties go to the smaller id; a query doesn't meet rows of its own id; repeated rows are
candidates each; very long vectors are taken whole; scores beyond 64 bits are held at the largest or smallest long; an
empty table gives an empty result. Columns beyond id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.llm.common import bound_batches, cut_lineage, distinct_names, read_table

SCALE = 1024
K = 10
QUERY_EVERY = 100
#: Vectors of a block; vectors in the sample for the rotation.
BLOCK = 1024
SAMPLE = 4096
#: Blocks of queries, of a quarter of that size, in a group.
GROUP_BLOCKS = 16
_PACKED = "range int, block int, n int, longest double, ids binary, whole binary, turned binary"
_SAFE = 2**62


def quantized(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, v array of double integers, length) of the vectors that take part."""
    v = F.col(vector_column)
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))) & F.col(id_column).isNotNull()
    whole = F.transform(v, lambda x: F.rint(F.floor(x.cast("double") * SCALE).cast("double")))
    df = distinct_names(vectors, id_column, vector_column).filter(sound).select(F.col(id_column).cast("long").alias("vec_id"), whole.alias("v"))
    return df.withColumn("length", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Orthogonal matrix from the right singular vectors of at most ``SAMPLE`` vectors."""
    sample = vectors.select(F.xxhash64("vec_id").alias("h"), "vec_id", "v").orderBy("h", "vec_id").limit(SAMPLE).select("v").collect()
    if not sample or not width:
        return np.eye(width)
    return np.linalg.svd(_matrix([r[0] for r in sample], width), full_matrices=True)[2].T


def _matrix(rows: list, width: int) -> np.ndarray:
    m = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        m[k, : len(r)] = r
    return m


def _packed(vectors: DataFrame, width: int, turn: np.ndarray, size: int) -> DataFrame:
    """Blocks of the partitions' vectors in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, ids, rows = TaskContext.get().partitionId(), 0, [], []

        def made() -> pa.RecordBatch:
            m = _matrix(rows, width)
            whole = np.clip(m, -(2.0**62), 2.0**62).astype(np.int64)
            values = [[part], [block], [len(rows)], [float(np.sqrt((m * m).sum(1)).max())], [np.array(ids, np.int64).tobytes()], [whole.tobytes()], [(m @ turn).tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=[c.split()[0] for c in _PACKED.split(", ")])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                rows.append(v)
                if len(rows) == size:
                    yield made()
                    block, ids, rows = block + 1, [], []
        if rows:
            yield made()

    return vectors.select("vec_id", "v").mapInArrow(run, _PACKED)


class Block:
    """A packed block with the lengths of its vectors and of what is left beyond each cut of the rotated components."""

    def __init__(self, n: int, ids: bytes, whole: bytes, turned: bytes) -> None:
        self.ids = np.frombuffer(ids, np.int64)
        self.whole = np.frombuffer(whole, np.int64).reshape(n, -1)
        self.turned = np.frombuffer(turned, np.float64).reshape(n, -1)
        self.length = np.sqrt((self.turned**2).sum(1))
        self.left = np.sqrt(np.maximum(0, np.cumsum((self.turned**2)[:, ::-1], axis=1)[:, ::-1]))

    def residual(self, cut: int) -> np.ndarray:
        return self.left[:, cut] if cut < self.turned.shape[1] else np.zeros(len(self.ids))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows, held to 64 bits."""
    if not len(a):
        return np.zeros(0, np.int64)
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < _SAFE:
        return (a * b).sum(1)
    exact = (a.astype(object) * b.astype(object)).sum(1)
    return np.array([max(-(2**63), min(2**63 - 1, int(x))) for x in exact], np.int64)


Found = tuple[np.ndarray, np.ndarray, np.ndarray]
NOTHING: Found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def search(queries: Block, candidates: Block, least: np.ndarray, k: int, found: Found = NOTHING, chunk: int = 256) -> tuple[Found, np.ndarray]:
    """What was ``found`` (rows of queries, ids, scores) with the candidates that reach ``least``, the k best of each query; and the new bounds."""
    width = queries.turned.shape[1]
    cuts = sorted({c for c in (width // 8, width // 3) if 0 < c < width})
    order = np.argsort(-candidates.length, kind="stable")
    q_of, ids, scores = found
    least = least.copy()
    for at in range(0, len(order), chunk):
        some = order[at : at + chunk]
        reach = queries.length * candidates.length[some[0]]
        slack = 1e-6 * (1 + reach)
        live = np.flatnonzero(reach + slack >= least)
        if not len(live):
            break
        alive = None
        for cut in cuts:
            bound = queries.turned[live, :cut] @ candidates.turned[some, :cut].T + np.outer(queries.residual(cut)[live], candidates.residual(cut)[some])
            near = bound + slack[live, None] >= least[live, None]
            alive = near if alive is None else alive & near
        q, c = np.nonzero(alive) if alive is not None else map(np.ravel, np.indices((len(live), len(some))))
        q, c = live[q], some[c]
        other = queries.ids[q] != candidates.ids[c]
        q, c = q[other], c[other]
        q_of, ids = np.concatenate([q_of, q]), np.concatenate([ids, candidates.ids[c]])
        scores = np.concatenate([scores, products(queries.whole[q], candidates.whole[c])])
        ranked = np.lexsort((ids, ~scores, q_of))  # ~s orders as -s does, without overflow
        q_of, ids, scores = q_of[ranked], ids[ranked], scores[ranked]
        rank = np.arange(len(q_of)) - np.searchsorted(q_of, q_of)
        q_of, ids, scores, rank = (x[rank < k] for x in (q_of, ids, scores, rank))
        last = rank == k - 1
        least[q_of[last]] = np.maximum(least[q_of[last]], scores[last])
    return (q_of, ids, scores), least


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query, a vector whose id meets ``is_query`` (over vec_id), its k best others."""
    spark = vectors.sparkSession
    bound_batches(spark)
    ready = cut_lineage(quantized(vectors, id_column, vector_column))
    width = ready.agg(F.max(F.size("v"))).first()[0] or 0
    turn = rotation(ready, width)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = ready.repartitionByRange(ranges, F.desc("length"), "vec_id").sortWithinPartitions(F.desc("length"), "vec_id")
    candidates = cut_lineage(_packed(sorted_, width, turn, BLOCK))
    # one row for each range, as many as there are shuffle partitions
    longest = {r[0]: r[1] for r in candidates.groupBy("range").agg(F.max("longest")).collect()}
    if not longest:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    first = candidates.filter((F.col("range") == min(longest)) & (F.col("block") == 0)).select("n", "ids", "whole", "turned").first()
    seed, names = tuple(first), sorted(longest)
    asked = ready.filter(is_query)
    parts = max(1, -(-asked.count() // (GROUP_BLOCKS * BLOCK // 4)))
    packed = _packed(asked.repartition(parts, "vec_id"), width, turn, BLOCK // 4)
    shape = "n int, ids binary, whole binary, turned binary, least binary"

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the bounds of each query's k-th score, the ranges that can reach them and the length needed for it."""
        top = Block(*seed)
        for batch in batches:
            for row in batch.to_pylist():
                queries = Block(row["n"], row["ids"], row["whole"], row["turned"])
                least = search(queries, top, np.full(row["n"], -np.inf), k)[1]
                need = float(np.where(queries.length > 0, least / np.maximum(queries.length, 1e-300), np.where(least > 0, np.inf, -np.inf)).min())
                reach = [r for r in names if longest[r] * (1 + 1e-5) + 1e-3 >= need]
                made = {"to": reach, "part": row["range"], "group": row["block"] // GROUP_BLOCKS, "need": need, "n": row["n"], "ids": row["ids"], "whole": row["whole"], "turned": row["turned"], "least": least.tobytes()}
                yield pa.RecordBatch.from_pylist([made], schema=pa.schema([("to", pa.list_(pa.int32())), ("part", pa.int32()), ("group", pa.int32()), ("need", pa.float64()), ("n", pa.int32()), *((c, pa.binary()) for c in ("ids", "whole", "turned", "least"))]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A group's queries, then the blocks of a range by descending length."""
        of, queries, found, least = None, [], [], []

        def best() -> pa.RecordBatch:
            ids = np.concatenate([q.ids[f[0]] for q, f in zip(queries, found, strict=True)])
            rest = [np.concatenate([f[c] for f in found]) for c in (1, 2)]
            return pa.RecordBatch.from_arrays([pa.array(ids), *map(pa.array, rest)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for row in range(len(batch)):
                *key, n, ids, whole, turned, bounds = (c[row].as_py() for c in batch.columns)
                if key != of:
                    if queries:
                        yield best()
                    of, queries, found, least = key, [], [], []
                block = Block(n, ids, whole, turned)
                if bounds is not None:
                    queries.append(block)
                    found.append(NOTHING)
                    least.append(np.frombuffer(bounds, np.float64))
                else:
                    for at, q in enumerate(queries):
                        found[at], least[at] = search(q, block, least[at], k, found[at])
        if queries:
            yield best()

    queries = cut_lineage(packed.mapInArrow(bounded, f"to array<int>, part int, group int, need double, {shape}")).withColumn("range", F.explode("to"))
    needs = queries.groupBy("range", "part", "group").agg(F.min("need").alias("need"))
    data, key = [c.split()[0] for c in shape.split(", ")], ["range", "part", "group"]
    sent = candidates.join(needs, "range").filter(F.col("longest") * (1 + 1e-5) + 1e-3 >= F.col("need")).select(*key, F.col("block").alias("at"), *data[:-1], F.lit(None).cast("binary").alias("least"))
    rows = queries.select(*key, F.lit(-1).alias("at"), *data).unionByName(sent)
    found = rows.repartition(*key).sortWithinPartitions(*key, "at").drop("at").mapInArrow(scored, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)
