"""Mixing sources to target weights (operator 3), in DataFrame functions only.

A source's share of all tokens, raised to an exponent between 0 (all alike) and 1 (as they are) and normalised, is its
weight. The exponent is found by bisection, several candidates to a pass over the table of sources: either the least
one under which no source is repeated more than ``repetition_limit`` times as often as the least repeated one, or the
one whose weights have a target entropy. Weights become token budgets, at least as many as a source has (nothing is
left out) or a share of a given total.

A budget is realised as whole epochs of a source plus part of one, taken along a fixed permutation: rows are dealt by
a hash into blocks of about ``BLOCK_ROWS``, whole blocks are taken until the budget is within one, and rows of that
block in the order of their hash. The cut is found from sums of blocks, and blocks of super-blocks, so neither a large
source nor its permutation meets in one task, and texts are never shuffled. ``place`` puts the occurrences of each
source evenly over the mixture.

Tokens are words (runs without white space). Defined results: a null source is a source of its own; null and empty
texts have no tokens and are taken with their block's rows; very long texts are counted whole; repeated rows, and others
whose hashes tie, share their place and are taken together; with no tokens at all every row is taken once; an empty
table gives an empty result; null ids take part. Extra columns are kept as they are, whatever their names, but for
``epoch`` and ``place``, which are made anew.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.llm.common import cut_lineage, distinct_names, read_table, whole_rows

REPETITION_LIMIT = 1.5
BLOCK_ROWS = 1000
SEED = 17
#: Sources up to which their table, some 100 bytes each, is broadcast; beyond, rows are joined by source.
BROADCAST_SOURCES = 100_000
#: Passes of the bisection and exponents tried in each: the last step is (TRIED + 1) ** -PASSES.
PASSES, TRIED = 5, 15
_SCALE = 1 << 62


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def shares(sources: DataFrame) -> DataFrame:
    """Adds p, the share of all tokens; sources without tokens have 0."""
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    return sources.withColumn("p", F.col("tokens") / F.lit(float(max(total, 1))))


def _statistics(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """Entropy of the weights and the ratio of repetitions for each exponent, in one pass."""
    some, parts = sources.filter("p > 0"), []
    for k, a in enumerate(exponents):
        w = F.pow("p", F.lit(a))
        parts += [F.sum(w).alias(f"z{k}"), F.sum(w * F.log(w)).alias(f"l{k}"), F.max(w / F.col("p")).alias(f"h{k}"), F.min(w / F.col("p")).alias(f"m{k}")]
    row = some.agg(*parts).first()
    return [(float(log(row[f"z{k}"]) - row[f"l{k}"] / row[f"z{k}"]), row[f"h{k}"] / row[f"m{k}"]) for k in range(len(exponents))]


def exponent(sources: DataFrame, repetition_limit: float | None = REPETITION_LIMIT, entropy: float | None = None) -> float:
    """The exponent that meets the repetition limit or, if given, the target entropy in nats (clipped to what there is)."""
    if sources.filter("p > 0").isEmpty():
        return 1.0
    if entropy is None and repetition_limit is None:
        raise ValueError("a repetition limit or an entropy is needed")
    enough = (lambda s: s[0] <= entropy) if entropy is not None else (lambda s: s[1] <= repetition_limit)
    low, high = 0.0, 1.0
    if enough(_statistics(sources, [0.0])[0]):
        return 0.0
    for _ in range(PASSES):
        tried = [low + (high - low) * k / (TRIED + 1) for k in range(1, TRIED + 1)]
        met = [enough(s) for s in _statistics(sources, tried)]
        first = next((k for k, m in enumerate(met) if m), TRIED)
        low, high = (tried[first - 1] if first else low), (tried[first] if first < TRIED else high)
    return high


def _source_key(df: DataFrame) -> list[Column]:
    return [F.coalesce("source", F.lit("")).alias("_s"), F.col("source").isNull().alias("_no")]


def _place(df: DataFrame, seed: int) -> Column:
    """Place in the source's permutation, from 0 to 2^62."""
    return F.xxhash64(F.lit(seed), "doc_id", "text").bitwiseAND(F.lit(_SCALE - 1))


def plan(docs: DataFrame, repetition_limit: float | None = REPETITION_LIMIT, entropy: float | None = None, total_tokens: int | None = None, seed: int = SEED) -> DataFrame:
    """One row for each source: tokens, p, weight, budget, epochs, and the place ``cut`` before which rows are taken once more."""
    docs = distinct_names(docs, "doc_id", "text", "source")
    narrow = cut_lineage(docs.select(*_source_key(docs), tokens(F.col("text")).alias("tokens"), _place(docs, seed).alias("at")))
    key = ["_s", "_no"]
    sources = cut_lineage(shares(narrow.groupBy(*key).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))))
    a = exponent(sources, repetition_limit, entropy)
    weighed = sources.withColumn("w", F.when(F.col("p") > 0, F.pow("p", F.lit(a))).otherwise(F.lit(0.0)))
    z, least = weighed.agg(F.sum("w"), F.min(F.when(F.col("p") > 0, F.col("w") / F.col("p")))).first()
    weighed = weighed.withColumn("weight", F.col("w") / F.lit(z or 1.0))
    # without a total, the least repeated source is taken exactly once
    budget = F.col("weight") * F.lit(float(total_tokens)) if total_tokens is not None else F.col("tokens") * F.col("w") / F.col("p") / F.lit(least or 1.0)
    weighed = weighed.withColumn("budget", F.when(F.col("p") > 0, F.round(budget).cast("long")).otherwise(F.lit(0).cast("long")))
    alone = F.when(F.col("p") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(1))
    weighed = cut_lineage(weighed.withColumn("epochs", alone.cast("long")).withColumn("rest", F.when(F.col("p") > 0, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(F.lit(0))))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("rows") / BLOCK_ROWS)).cast("long")
    fine = weighed.select(*key, "rest", blocks.alias("blocks"), F.greatest(F.lit(1), F.ceil(F.sqrt(blocks))).cast("long").alias("wide"))
    block = F.floor(F.col("at") / F.lit(float(_SCALE)) * F.col("blocks")).cast("long")
    small = _few(weighed)
    dealt = narrow.join(small(fine.filter("rest > 0")), key).withColumn("block", F.least(block, F.col("blocks") - 1)).withColumn("super", F.floor(F.col("block") / F.col("wide")).cast("long"))
    # the super-block, then the block, then the row in which the budget ends
    supers = dealt.groupBy(*key, "super", "rest").agg(F.sum("tokens").alias("n"))
    in_super = small(_ends_in(supers, key, "super"))
    blocks_of = dealt.join(in_super.withColumnRenamed("rest", "left"), [*key, "super"]).groupBy(*key, "block", "left").agg(F.sum("tokens").alias("n"))
    in_block = cut_lineage(_ends_in(blocks_of.withColumnRenamed("left", "rest"), key, "block"))
    rows_of = dealt.drop("rest").join(small(in_block.select(*key, "block", "rest")), [*key, "block"]).groupBy(*key, "at", "rest").agg(F.sum("tokens").alias("n"))
    cut = _ends_in(rows_of, key, "at").select(*key, F.col("at").alias("cut"))
    return cut_lineage(weighed.join(cut, key, "left").select(*key, "tokens", "rows", "p", "weight", "budget", "epochs", F.coalesce("cut", F.lit(0)).alias("cut")))


def _few(sources: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """What marks tables of one row a source for broadcast, if there are few enough sources."""
    return F.broadcast if sources.count() <= BROADCAST_SOURCES else lambda df: df


def _ends_in(parts: DataFrame, key: list[str], order: str) -> DataFrame:
    """Of each source's parts (with n tokens), the one in which ``rest`` tokens end, with what is left of them there.

    A part that the budget just fills leaves 0 for the next one; where all parts are filled there is none.
    """
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return parts.withColumn("_before", before).filter((F.col("_before") <= F.col("rest")) & (F.col("rest") < F.col("_before") + F.col("n"))).withColumn("rest", F.col("rest") - F.col("_before")).drop("_before", "n")


def mix(docs: DataFrame, seed: int = SEED, **target: float | int | None) -> DataFrame:
    """The rows of ``docs``, each as often as its source's budget asks, with ``epoch`` (from 1) and ``place`` (0 to 1) in the mixture,
    instead of columns of those names.

    Rows lie in the mixture by ``place``; for ``target`` see ``plan``.
    """
    times = F.when(F.col("tokens") > 0, F.col("budget") / F.col("tokens")).otherwise(F.lit(1.0))
    planned = plan(docs, seed=seed, **target).select("_s", "_no", "epochs", "cut", times.alias("times"))
    rows = whole_rows(docs, "doc_id", "text", "source")
    keyed = rows.select(*_source_key(rows), _place(rows, seed).alias("at"), "row").join(_few(planned)(planned), ["_s", "_no"])
    taken = F.col("epochs") + F.when(F.col("at") < F.col("cut"), F.lit(1)).otherwise(F.lit(0))
    rows = keyed.withColumn("taken", taken.cast("int")).filter("taken > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("taken"))))
    place = (F.col("epoch") - 1 + F.col("at") / F.lit(float(_SCALE))) / F.greatest(F.col("times"), F.lit(1e-12))
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("epoch", "place")]
    return rows.select(*kept, F.col("epoch"), F.least(place, F.lit(1.0)).alias("place"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document stands where in the mixture, and in which epoch of its source."""
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "source", "epoch", "place")
