"""Quality rules under weak supervision (operator 10).

Each rule votes for or against a text or abstains. Expectation-maximisation over the counts of vote patterns (at most
3 to the number of rules, however many texts there are) estimates how often each rule votes against good and against
bad texts; the posterior probability of being good, given all votes, decides, rather than passing every rule.
Abstaining says nothing about a text. A rule keeps its direction: its votes against bad texts are at least ``RATIO``
times as frequent as those against good ones, so a rule that alone knows a kind of bad text isn't talked out of it.

Defined results: null and empty texts have no words and fail the base rules; very long texts are measured whole, one to
a batch if need be; every row gets one row, repeated rows alike; equal odds keep a text; an empty table gives an empty
result and a model in which no vote counts. The posterior depends on the whole table. A null id is kept as it is.
Columns beyond id and text are not read by ``assess``; ``keep_good`` returns all of them, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, LongType, StructField, StructType

from pairloom.llm.common import bound_batches, cut_lineage, distinct_names, read_table, texts, whole_rows

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"
MIN_WORDS = 50
#: Rule: share, at most this good, at least that bad; between them the rule abstains.
RULES = {
    "symbols": (0.02, 0.1),  # symbols a word
    "repeats": (0.1, 0.3),  # words in repeated windows
    "sameness": (0.5, 0.75),  # words that occurred before
    "capitals": (0.1, 0.3),  # of A-Z a-z
    "lines": (0.0, 0.5),  # lines with a word that occurred before
    "stops": (0.3, 0.6),  # . ? ! a word
    "shortness": (0.01, 0.0204),  # 1 / words: at least 100, fewer than 50
    "spelling": (0.2, 0.45),  # distance of the mean word length from 5.5, against 5.5
}
MEASURES = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_LETTER = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122))
EM_STEPS = 200
#: What a rule is taken to do before the data speak, with this share of all texts as weight: votes against good and bad texts.
MISS, HIT, SMOOTHING = 0.001, 0.2, 0.01
#: A vote against is at least so many times as frequent for bad texts as for good ones.
RATIO = 20.0


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    of = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n + 2)
    if len(ids) == n + 2:
        return 0
    pairs = np.unique(of[:-2] * len(ids) + of[1:-1], return_inverse=True)[1] if len(ids) > 1 << 20 else of[:-2] * len(ids) + of[1:-1]
    _, which, count = np.unique(pairs * len(ids) + of[2:], return_inverse=True, return_counts=True)
    again = count[which] > 1
    inside = np.zeros(n + 2, bool)
    for k in range(3):
        inside[k : n + k] |= again
    return int(inside.sum())


def measures(text: str) -> tuple[int, int, int, int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then lines, distinct words, capitals, letters, stops."""
    raw = text.encode("utf-8")
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(raw.count, SYMBOLS.encode())),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(set(words)),
        len(raw.translate(None, _NOT_UPPER)),
        len(raw.translate(None, _NOT_LETTER)),
        raw.count(b".") + raw.count(b"?") + raw.count(b"!"),
    )


def votes(m: np.ndarray) -> np.ndarray:
    """Votes, 1 good, -1 bad or 0, by text and rule; ``m`` has the measures of a text in each row."""
    words, chars, symbols, dup, repeats, lines, distinct, upper, letters, stops = m.T.astype(float)
    n = np.maximum(words, 1)
    shares = {
        "symbols": symbols / n,
        "repeats": repeats / n,
        "sameness": 1 - distinct / n,
        "capitals": upper / np.maximum(letters, 1),
        "lines": dup / np.maximum(lines, 1),
        "stops": stops / n,
        "shortness": 1 / n,
        "spelling": np.abs(chars / n - 5.5) / 5.5,
    }
    return np.stack([(shares[r] <= good).astype(np.int8) - (shares[r] >= bad) for r, (good, bad) in RULES.items()], axis=1)


def assess(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The id, ``extra`` columns, measures and votes (array of tinyint ``votes``) of every row."""
    bound_batches(docs.sparkSession)
    keep = ["doc_id", *(c for c in extra if c not in ("doc_id", "text"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.array([measures(t) for t in texts(batch.column(0))], np.int64).reshape(-1, 10)
            v = votes(m)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(m[:, k]) for k in range(5)), pa.array(list(v), pa.list_(pa.int8()))], names=[*keep, *MEASURES, "votes"])

    made = [*(StructField(c, LongType()) for c in MEASURES), StructField("votes", ArrayType(ByteType()))]
    return distinct_names(docs, "text", *keep).mapInArrow(run, StructType([*(docs.schema[c] for c in keep), *made]))


def fit(patterns: list[tuple[list[int], int]]) -> list[tuple[float, float]]:
    """For each rule the log-odds of being good that a vote for adds and that a vote against adds.

    ``patterns`` has vote patterns and how many texts have them. Classes have even odds before any vote: a rare kind of
    bad text that one rule alone knows isn't outvoted by how common good texts are. Starts from the votes (a text with a
    vote against is bad, more likely than not); rates are smoothed by a share of all texts, so the fit is alike at
    every size. Where counts would bring a rule's rates nearer than ``RATIO``, both are what its pooled counts say at
    that ratio. With no texts nothing counts.
    """
    if not patterns:
        return [(0.0, 0.0)] * len(RULES)
    v, n = np.array([p for p, _ in patterns]), np.array([c for _, c in patterns], float)
    for_, against = (v == 1).astype(float), (v == -1).astype(float)
    good, smooth = np.where(against.sum(1) > 0, 0.1, 0.9), SMOOTHING * n.sum()
    for _ in range(EM_STEPS):
        w, u = n * good, n * (1 - good)
        no_good, all_good = w @ against + MISS * smooth, w @ (for_ + against) + smooth  # votes against good texts, all on them
        no_bad, all_bad = u @ against + HIT * smooth, u @ (for_ + against) + smooth
        apart = no_bad / all_bad >= RATIO * no_good / all_good
        pooled = np.minimum((no_good + no_bad) / (all_good + RATIO * all_bad), 0.999 / RATIO)
        miss, hit = np.where(apart, no_good / all_good, pooled), np.where(apart, no_bad / all_bad, RATIO * pooled)
        pro, con = np.log((1 - miss) / (1 - hit)), np.log(miss / hit)
        now = 1 / (1 + np.exp(-np.clip(for_ @ pro + against @ con, -700, 700)))
        if np.abs(now - good).max() < 1e-9:
            break
        good = now
    return [(round(float(a), 9), round(float(b), 9)) for a, b in zip(pro, con, strict=True)]


def posterior(model: list[tuple[float, float]]) -> Column:
    """Probability of being good, from the column ``votes``."""
    odds = F.lit(0.0)
    for k, (pro, con) in enumerate(model):
        vote = F.col("votes")[k]
        odds = odds + F.when(vote == 1, F.lit(pro)).when(vote == -1, F.lit(con)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-odds))


def learn(assessed: DataFrame) -> list[tuple[float, float]]:
    """Fit to all rows; the driver gets one row for each vote pattern, 3 to the number of rules at most."""
    return fit(sorted((list(r[0]), r[1]) for r in assessed.groupBy("votes").count().collect()))


def judged(assessed: DataFrame, model: list[tuple[float, float]]) -> DataFrame:
    """Adds base_failed, p_good and kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return assessed.withColumn("base_failed", failed).withColumn("p_good", posterior(model)).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept.

    Texts are measured twice, for the model and for the verdicts: to write the rows with their votes in between, or to
    shuffle them to their verdicts, takes as much disk as the input, measuring again takes none.
    """
    model = learn(assess(docs))
    return judged(assess(whole_rows(docs, "doc_id", "text"), ("row",)), model).filter("kept").select("row.*")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    assessed = cut_lineage(assess(read_table(spark, sf_dir, "documents")))
    return judged(assessed, learn(assessed)).select("doc_id", *MEASURES, "base_failed", "kept", "p_good")
