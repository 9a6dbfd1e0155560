"""URL filters as a sort-merge range join (operator 5).

A host with its labels reversed and closed by dots (``com.example.``) is a canonical key under which a rule's host and
all its subdomains are one interval, the keys it is a prefix of. Intervals nest or are disjoint, so one sweep over
sorted keys with a stack of the rules' intervals that are open finds all rules whose host fits; below each, the path
rules nest in the same way and are searched by their order. The longest fitting rule wins, by host and path together,
then by host.

A rule set up to ``LOCAL_RULES`` goes to every task, which sorts its own keys and sweeps them; nothing is shuffled. A
larger one is dealt with the URLs by ranges of keys, a rule to every range that its interval meets. Bounds come from a
bounded sample of keys and affect only balance; rows of a key that fills several ranges are spread over them.

Defined results: a null URL or one without ``://`` has an empty host and path and fits no rule but one with an empty
host; without a rule the default verdict holds; every row gets one row, repeated rows alike; other columns are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import bound_batches, distinct_names, read_table

Rule = tuple[str, str, str]

# Host, path, verdict.
RULES: list[Rule] = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
DEFAULT = "allow"
LOCAL_RULES = 100_000
#: Keys sampled for a range's bounds.
SAMPLE_PER_RANGE = 40
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_key(host: str) -> str:
    """Labels from the last to the first, each closed by a dot."""
    return ".".join(reversed(host.split("."))) + "." if host else ""


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path columns of a URL."""
    rest = F.when(url.contains("://"), F.substring(url, F.locate("://", url) + 3, F.lit(2**31 - 1))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


class Interval:
    """A rule host's interval: its path rules in order, each with the nearest one that is a prefix of it."""

    __slots__ = ("above", "key", "paths", "rules")

    def __init__(self, key: str, rules: Iterable[Rule]) -> None:
        self.key = key
        self.rules = sorted(dict((r[1], r) for r in sorted(rules, key=lambda r: r[2])).values(), key=lambda r: r[1])
        self.paths, self.above, stack = [r[1] for r in self.rules], [], []
        for k, path in enumerate(self.paths):
            while stack and not path.startswith(self.paths[stack[-1]]):
                stack.pop()
            self.above.append(stack[-1] if stack else -1)
            stack.append(k)

    def fit(self, path: str) -> Rule | None:
        at = bisect.bisect_right(self.paths, path) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.above[at]
        return self.rules[at] if at >= 0 else None


def intervals(rules: Iterable[Rule]) -> list[Interval]:
    by: dict[str, list[Rule]] = {}
    for r in rules:
        by.setdefault(host_key(r[0]), []).append(r)
    return [Interval(k, by[k]) for k in sorted(by)]


def best(open_: list[Interval], path: str) -> Rule | None:
    """The longest rule of the open intervals; of equally long ones that of the longer host."""
    fits = [r for i in open_ if (r := i.fit(path))]
    return max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))) if fits else None


def sweep(keys: list[str], paths: list[str], order: Iterable[int], rules: list[Interval]) -> list[Rule | None]:
    """The rule of every URL; ``order`` sorts the keys."""
    found: list[Rule | None] = [None] * len(keys)
    starts, stack, at = [i.key for i in rules], [], 0
    for row in order:
        key = keys[row]
        while stack and not key.startswith(stack[-1].key):
            stack.pop()
        while at < len(rules) and rules[at].key <= key:
            if key.startswith(rules[at].key):
                stack.append(rules[at])
                at += 1
            else:  # its interval ended before this key; go on with the next one that is not below the last open one
                at = max(at + 1, bisect.bisect_left(starts, next((p for p in _prefixes(key) if p > starts[at]), key), at + 1))
        found[row] = best(stack, paths[row])
    return found


def _prefixes(key: str) -> Iterator[str]:
    """Keys of the hosts above a host, from the shortest."""
    return (key[: i + 1] for i, c in enumerate(key) if c == ".")


def _verdicts(found: list[Rule | None]) -> tuple[pa.Array, pa.Array]:
    return pa.array([r[0] + r[1] if r else None for r in found], pa.string()), pa.array([r[2] if r else DEFAULT for r in found], pa.string())


def judge(pages: DataFrame, rules: list[Rule] | DataFrame, id_column: str = "page_id", local_rules: int = LOCAL_RULES) -> DataFrame:
    """(id, host, path, rule, verdict) for every row; ``rules`` is a list or a DataFrame of host, path, verdict."""
    bound_batches(pages.sparkSession)
    host, path = parsed(F.col("url"))
    urls = distinct_names(pages, id_column, "url").select(id_column, host.alias("host"), path.alias("path"))
    schema = f"`{id_column}` {pages.schema[id_column].dataType.simpleString()}, host string, path string, rule string, verdict string"
    if isinstance(rules, DataFrame):
        if rules.limit(local_rules + 1).count() > local_rules:
            return _by_ranges(urls, rules, schema)
        rules = [tuple(r) for r in rules.select("host", "path", "verdict").collect()]
    elif len(rules) > local_rules:
        return _by_ranges(urls, pages.sparkSession.createDataFrame(rules, "host string, path string, verdict string"), schema)
    known = intervals(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [host_key(h.as_py()) for h in batch.column(1)]
            rule, verdict = _verdicts(sweep(keys, batch.column(2).to_pylist(), sorted(range(len(keys)), key=keys.__getitem__), known))
            yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdict], names=[*batch.schema.names, "rule", "verdict"])

    return urls.mapInArrow(run, schema)


def _by_ranges(urls: DataFrame, rules: DataFrame, schema: str) -> DataFrame:
    """Both sides dealt by ranges of keys and swept as sorted streams."""
    spark = urls.sparkSession
    key = lambda host: F.when(host == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = urls.withColumn("key", key(F.col("host")))
    sample = keyed.select("key", F.xxhash64("host", "path").alias("h")).orderBy("h").limit(SAMPLE_PER_RANGE * ranges).collect()
    keys = sorted(r[0] for r in sample)
    bounds = [keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else []
    id_column, names = urls.columns[0], ["range", "kind", "key", "host", "path", "verdict", "id"]
    id_type = urls.schema[id_column].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int]] = []
            for row, (kind, key, spread) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("kind", "key", "spread")), strict=True)):
                low = bisect.bisect_left(bounds, key)
                high = bisect.bisect_right(bounds, key + "\U0010ffff" if kind == 0 else key)
                out += [(row, r) for r in range(low, high + 1)] if kind == 0 else [(row, low + spread % (high - low + 1))]
            at = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([o[1] for o in out], pa.int32()), *(batch.column(k).take(at) for k in names[1:])], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[Interval] = []
        held: list[Rule] = []
        now = None
        for batch in batches:
            ids, hosts, paths, found = [], [], [], []
            for row, (range_, kind, key, host, path, verdict) in enumerate(zip(*(batch.column(k).to_pylist() for k in names[:6]), strict=True)):
                if range_ != now:
                    now, stack, held = range_, [], []
                if held and (kind == 1 or key != host_key(held[0][0])):
                    stack.append(Interval(host_key(held[0][0]), held))
                    held = []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind == 0:
                    held.append((host, path, verdict))
                else:
                    ids.append(row)
                    hosts.append(host)
                    paths.append(path)
                    found.append(best(stack, path))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(ids, pa.int64())), pa.array(hosts, pa.string()), pa.array(paths, pa.string()), *_verdicts(found)], names=[id_column, "host", "path", "rule", "verdict"])

    both = keyed.select(F.lit(1).alias("kind"), "key", "host", "path", F.lit("").alias("verdict"), F.col(id_column).alias("id"), F.abs(F.hash("path", id_column)).cast("long").alias("spread"))
    more = rules.select(F.lit(0).alias("kind"), key(F.col("host")).alias("key"), "host", "path", "verdict", F.lit(None).cast(id_type).alias("id"), F.lit(0).cast("long").alias("spread"))
    placed = both.unionByName(more).mapInArrow(place, f"range int, kind int, key string, host string, path string, verdict string, id {id_type}")
    return placed.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "key", "kind").mapInArrow(run, schema)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    return judge(read_table(spark, sf_dir, "pages"), RULES)
