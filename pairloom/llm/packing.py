"""Best-fit packing of documents into fixed token sequences (operator 4).

Documents become pieces of at most ``capacity`` tokens; only longer documents are cut. Packing then works on the
histogram of piece lengths, which has ``capacity`` entries however many pieces there are:

* pieces above a third of the capacity stand at most two in a sequence: from the longest down, each length is matched
  with the longest one that still fits beside it;
* shorter pieces, from the longest down, go to the tightest gap that holds them, and open a new sequence if none does.

Equal lengths move as runs, so the plan is a list of segments "the pieces of this length with these ranks go to these
sequences at this offset". Its size follows from the capacity, not from the data (see ``MAX_SEGMENTS``); it is what
goes to the executors. A piece's rank among those of its length comes from salted counts: no group of equal lengths,
however large, meets in one task.

Defined results: a null text counts as empty, and an empty document is one piece that holds the end token alone; very
long texts are encoded whole, one to a batch if need be. Pieces of equal length are interchangeable: which of them stands
where follows from id, number and checksum, and among repeated rows, which are packed as often as they occur, from the
order in which they are read. Null ids take part; an empty table gives an empty result. Columns beyond id and text are
not read by ``token_pieces``; ``pack`` keeps further columns of pieces, whatever their names, but for ``sequence_id``
and ``offset``, which are made anew.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pairloom.llm.common import bound_batches, cut_lineage, distinct_names, read_table, texts, whole_rows

CAPACITY = 4096
END_ID = 1
#: Entries of a worker's word cache, about; when full, it starts anew, and the one before is kept beside it.
CACHE_ENTRIES = 600_000
#: Letters whose normal form is their lower case, a letter again; small ones alone of A-Z.
LETTERS = "a-zÀ-ÖØ-öø-įı-ɏ"
#: Words that the tokenizer's pattern cuts as ``RUNS`` does.
PLAIN = re.compile(f"[!-@\\[-~{LETTERS}]+")
RUNS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
#: Pieces of one length that meet in one ranking group, about.
RANK_GROUP = 100_000
#: The most segments a plan may have, 48 bytes each; from capacity and run splitting, checked before it is sent.
MAX_SEGMENTS = 2_000_000
PIECE_COLUMNS = "doc_id", "piece", "start", "length", "ids_crc32"


class WordEncoder:
    """Token ids as little-endian bytes, by white-space separated words in UTF-8.

    The tokenizer drops white space and no token spans it, so words are encoded independently. Words in the cache
    cost a look-up. Missing ones of plain characters are cut into runs as the tokenizer's pattern cuts them; the library
    encodes missing runs, without normalising and cutting them again, and the words that are left.
    """

    def __init__(self, tokenizer_file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.of_runs = Tokenizer.from_file(tokenizer_file)
        self.of_runs.normalizer = normalizers.Lowercase()
        self.of_runs.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.special = re.compile(b"|".join(re.escape(token.content.encode()) for token in self.tokenizer.get_added_tokens_decoder().values()) or b"(?!)")
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a run
        self.closing[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # the cache before; what is met again is taken over

    def _lower(self, text: str) -> bytes:
        """Lower-cases A-Z, if the ids surely stay the same: without marks (U+0300 to U+037F) and special tokens."""
        raw = text.encode()
        lower = raw.lower()
        return raw if b"\xcc" in raw or b"\xcd" in raw or self.special.search(lower) else lower

    def _runs(self, word: bytes) -> list[bytes]:
        """Runs of a word of plain characters; none for other words."""
        if word.isalpha():
            return [word]
        text = word.decode()
        if not PLAIN.fullmatch(text) or self.special.search(word):
            return []
        return [r.encode() for r in RUNS.findall(text)]

    def _whole(self, words: list[bytes]) -> dict[bytes, bytes]:
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return {w: np.array(e.ids, "<u4").tobytes() for w, e in zip(words, encoded, strict=True)}

    def _joined(self, runs: list[bytes]) -> dict[bytes, bytes]:
        """A run ends with its only closing token, so runs are encoded as one text and cut there."""
        ids = np.array(self.of_runs.encode_batch_fast([b" ".join(runs).decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * (np.flatnonzero(self.closing[ids]) + 1)).tolist()
        if len(ends) != len(runs):
            return self._whole(runs)
        raw = ids.tobytes()
        return {r: raw[i:j] for r, i, j in zip(runs, [0, *ends], ends, strict=False)}

    def learn(self, missing: set[bytes]) -> None:
        """Add missing words and their runs."""
        if len(self.words) + len(missing) > CACHE_ENTRIES:
            self.older, self.words = self.words, {}
        words, older = self.words, self.older
        cut: dict[bytes, list[bytes]] = {}
        new: set[bytes] = set()
        others = []
        for w in missing:
            if (known := older.get(w)) is not None:
                words[w] = known
                continue
            runs = self._runs(w)
            if not runs:
                others.append(w)
            elif len(runs) > 1:
                cut[w] = runs
            for r in runs:
                if r not in words:
                    if (known := older.get(r)) is not None:
                        words[r] = known
                    else:
                        new.add(r)
        for some, encode in ((list(new), self._joined), (others, self._whole)):
            for k in range(0, len(some), 2_000):
                words.update(encode(some[k : k + 2_000]))
        words.update((w, b"".join(map(words.__getitem__, runs))) for w, runs in cut.items())

    def encode(self, some: list[str]) -> list[bytes]:
        """Ids of texts; what is missing in the cache is learnt for all of them at once."""
        words: list[bytes] = []
        ends = []
        for text in some:
            words += self._lower(text).split()
            ends.append(len(words))
        found = list(map(self.words.get, words))
        if gaps := [k for k, ids in enumerate(found) if ids is None]:
            self.learn({words[k] for k in gaps})
            for k in gaps:
                found[k] = self.words[words[k]]
        return [b"".join(found[i:j]) for i, j in zip([0, *ends], ends, strict=False)]


def _groups(some: Iterator[str], characters: int = 1 << 20) -> Iterator[list[str]]:
    """Texts in runs of about so many characters, one text at least."""
    group, size = [], 0
    for text in some:
        group.append(text)
        size += len(text)
        if size >= characters:
            yield group
            group, size = [], 0
    if group:
        yield group


@lru_cache(maxsize=1)
def _encoder(tokenizer_file: str) -> WordEncoder:
    """One for each Python worker, so that its caches outlive a task."""
    return WordEncoder(tokenizer_file)


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, and on request ``ids`` (array of int)."""
    bound_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(tokenizer_file), END_ID.to_bytes(4, "little")
        for batch in batches:
            of, piece, start, length, crc, ids_of = [], [], [], [], [], []
            encoded = (ids for group in _groups(texts(batch.column(1))) for ids in encoder.encode(group))
            for row, whole in enumerate(e + end for e in encoded):
                for k in range(0, len(whole), width):
                    part = whole[k : k + width]
                    of.append(row)
                    piece.append(k // width)
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids_of.append(np.frombuffer(part, "<u4").astype("i4"))
            columns = [batch.column(0).take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = list(PIECE_COLUMNS)
            if with_ids:
                columns, names = [*columns, pa.array(ids_of, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return distinct_names(docs, "doc_id", "text").mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Segments as rows (length, first rank, count, first sequence, pieces a sequence, offset) for a length histogram."""
    segments: list[tuple[int, int, int, int, int, int]] = []
    left = {a: n for a, n in counts.items() if n > 0}
    ranked = dict.fromkeys(left, 0)
    sequences = 0
    gaps: dict[int, list[tuple[int, int]]] = {}
    open_gaps: list[int] = []

    def put(length: int, n: int, sequence: int, each: int, offset: int) -> None:
        segments.append((length, ranked[length], n, sequence, each, offset))
        ranked[length] += n
        left[length] -= n

    def leave(gap: int, sequence: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(open_gaps, gap)
            gaps[gap].append((sequence, n))

    large = sorted(a for a in left if 3 * a > capacity)
    while large:
        a = large[-1]
        at = bisect.bisect_right(large, capacity - a) - 1
        b = large[at] if at >= 0 else None
        if b == a and left[a] == 1:
            b = large[at - 1] if at else None
        if b is None:
            n = left[a]
            put(a, n, sequences, 1, 0)
            leave(capacity - a, sequences, n)
        elif b == a:
            n = left[a] // 2
            put(a, 2 * n, sequences, 2, 0)
            leave(capacity - 2 * a, sequences, n)
        else:
            n = min(left[a], left[b])
            put(a, n, sequences, 1, 0)
            put(b, n, sequences, 1, a)
            leave(capacity - a - b, sequences, n)
        sequences += n
        large = [x for x in large if left[x]] if not left[a] or (b is not None and not left[b]) else large

    for s in sorted((a for a in left if 3 * a <= capacity), reverse=True):
        while left[s]:
            at = bisect.bisect_left(open_gaps, s)
            if at == len(open_gaps):
                n = ceil(left[s] / (capacity // s))
                leave(capacity, sequences, n)
                sequences += n
                continue
            gap = open_gaps[at]
            sequence, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], open_gaps[at]
            each = gap // s
            full = min(n, left[s] // each)
            if full:
                put(s, full * each, sequence, each, capacity - gap)
                leave(gap - each * s, sequence, full)
            if full < n and left[s]:
                rest = left[s]
                put(s, rest, sequence + full, rest, capacity - gap)
                leave(gap - rest * s, sequence + full, 1)
                full += 1
            leave(gap, sequence + full, n - full)
    return np.array(sorted(segments), dtype=np.int64).reshape(-1, 6)


def place(segments: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces by their length and their rank in it."""
    key = segments[:, 0] << 48 | segments[:, 1]
    row = segments[np.searchsorted(key, length << 48 | rank, side="right") - 1]
    nth = rank - row[:, 1]
    return row[:, 3] + nth // row[:, 4], row[:, 5] + nth % row[:, 4] * length


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (columns ``PIECE_COLUMNS``, further ones are kept).

    The pieces are written once: their lengths are read for the histogram and again for the placing. The driver gets
    one row for each length, ``capacity`` at most.
    """
    spark, names = pieces.sparkSession, [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    kinds = [pieces.schema[c] for c in names]
    pieces = cut_lineage(whole_rows(pieces.select(*[F.col(f"`{c}`") for c in names]), "doc_id", "piece", "length", "ids_crc32"))
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    segments = plan(counts, capacity)
    if len(segments) > MAX_SEGMENTS:
        raise ValueError(f"the packing plan has {len(segments)} segments, more than {MAX_SEGMENTS}")
    salts = max(64, ceil(sum(counts.values()) / RANK_GROUP))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    w = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("length", "salt", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(within)).join(before, ["length", "salt"])
    ranked = ranked.select("length", (F.col("before") + F.col("rank") - 1).alias("rank"), "row")
    sent = spark.sparkContext.broadcast(segments)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (c.to_numpy().astype(np.int64) for c in batch.columns[:2])
            sequence, offset = place(sent.value, length, rank) if len(batch) else (np.empty(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([*batch.column(2).flatten(), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, StructType([*kinds, StructField("sequence_id", LongType()), StructField("offset", LongType())]))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens of word_bpe_49k.json."""
    import public_tokenizers

    return pack(token_pieces(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))
