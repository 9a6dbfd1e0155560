"""Token counts by prefix dynamic programming (operator 9).

A byte-pair encoding is the only sequence of vocabulary pieces in which every adjacent pair is stable, that is,
in which encoding the two pieces' joined text gives the same two pieces again. So the last piece of the encoding
of every prefix can be found from left to right: of the pieces that end the prefix, exactly one stands in a stable
pair with the last piece of the prefix before it. ``count[i] = count[i - len(piece)] + 1`` then holds the exact
number of tokens of *every* prefix, and questions of truncation and budget need no second encoding.

No piece of the vocabulary crosses a word start (``x▁``) or holds a line feed, so a text is cut there into segments
that are encoded independently; the tables of frequent segments are kept in a bounded cache in each worker.

Defined results: null and empty texts have 0 tokens; each input row gives one output row, repeated rows included;
columns beyond the id and the text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pairloom.llm.common import bound_batches, distinct_names, read_table, texts

#: Entries of a worker's caches (of segments, of piece pairs); when full, a cache starts anew.
CACHE_ENTRIES = 800_000
TOKEN_LIMIT = 4096


class PrefixCounter:
    """Exact token counts of all prefixes under a sentencepiece BPE model."""

    def __init__(self, model_file: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("a BPE model with byte fallback and identity normalisation is needed")
        self.prefix = "▁" if model.normalizer_spec.add_dummy_prefix else ""
        self.score = {p.piece: p.score for p in model.pieces if p.type == 1}
        self.longest = max(map(len, self.score))
        glued = {c for p in self.score if len(p) > 1 for c in p}
        if any(re.search("[^▁]▁", p) for p in self.score) or "\n" in glued:
            raise ValueError("pieces cross word starts or lines")
        # a piece that its own encoding never reaches cannot occur
        self.score = {p: s for p, s in self.score.items() if len(p) == 1 or self._merged(p) == [p]}
        merged = sorted((p for p in self.score if len(p) > 1), key=lambda p: -self.score[p])
        self.rank = {p: k for k, p in enumerate([*(p for p in self.score if len(p) == 1), *merged])}
        self.halves = {p: self._halves(p) for p in merged}
        self.joined = {(p[i - 1], p[i]) for p in self.score for i in range(1, len(p))}
        self.pieces = ahocorasick.Automaton()
        for p in self.score:
            self.pieces.add_word(p, p)
        self.pieces.make_automaton()
        self.stable: dict[tuple[str, str], bool] = {}
        self.last_count: dict[str, int] = {}

    def _merged(self, text: str) -> list[str]:
        """Encoding by merges, best score first and leftmost among equals; for short strings."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _halves(self, piece: str) -> tuple[str, str]:
        """The two pieces whose merge makes this one last."""
        parts, score = list(piece), self.score
        while len(parts) > 2:
            s, i = max((score[x], -i) for i in range(len(parts) - 1) if (x := parts[i] + parts[i + 1]) in score)
            parts[-i : 2 - i] = [parts[-i] + parts[1 - i]]
        return parts[0], parts[1]

    def _is_stable(self, a: str, b: str) -> bool:
        """Whether no merge crosses the border of two pieces.

        Seen backwards in time: whichever of the two border pieces was merged last is taken apart again, and a piece
        that joins both would have had to come before the merge that is undone.
        """
        known = self.stable.get((a, b))
        if known is not None:
            return known
        if len(self.stable) >= CACHE_ENTRIES:
            self.stable.clear()
        key = (a, b)
        if "▁▁" in a + b:  # pieces of equal score: follow the merges themselves
            known = a + b not in self.score and self._merged(a + b) == [a, b]
        else:
            rank, halves, limit = self.rank, self.halves, len(self.rank) + 1
            while known is None:
                if rank.get(a + b, limit) < limit:
                    known = False
                elif a in halves and (rank[a] > rank[b] or b not in halves):
                    limit, a = rank[a], halves[a][1]
                elif b in halves:
                    limit, b = rank[b] + 1, halves[b][0]
                else:
                    known = True
        self.stable[key] = known
        return known

    def table(self, segment: str) -> list[int]:
        """Token counts of the prefixes of a segment, one for each length from 0 on."""
        n, stable, whole = len(segment), self.stable, 0
        counts, last = [0] + [-1] * n, [""] * (n + 1)
        for at, piece in self.pieces.iter(segment):  # by their ends, longer ones first
            end = at + 1
            if counts[end] >= 0:
                continue
            start = end - len(piece)
            while whole < start:
                whole += 1
                if counts[whole] < 0:  # a character without a piece: a token for each byte
                    counts[whole] = counts[whole - 1] + len(segment[whole - 1].encode("utf-8"))
            before = last[start]
            if before and not (known if (known := stable.get((before, piece))) is not None else self._is_stable(before, piece)):
                continue
            counts[end], last[end] = counts[start] + 1, piece
        while whole < n:
            whole += 1
            if counts[whole] < 0:
                counts[whole] = counts[whole - 1] + len(segment[whole - 1].encode("utf-8"))
        return counts

    def _split_count(self, segment: str) -> int:
        """Tokens of a segment whose closing punctuation, where no piece joins it to the rest, is looked up by itself."""
        base, cache = segment.rstrip(".,;:!?"), self.last_count
        tail = segment[len(base) :]
        if not base or not tail or (base[-1], tail[0]) in self.joined:
            return self.table(segment)[-1]
        for part in (base, tail):
            if part not in cache:
                cache[part] = self.table(part)[-1]
        return cache[base] + cache[tail]

    def segments(self, text: str) -> list[str]:
        """Independent segments in order; those of line feeds are left out, each is one token."""
        words = (self.prefix + text.replace(" ", "▁")).replace("▁", "\n▁")
        while "▁\n▁" in words:  # runs of spaces stay together
            words = words.replace("▁\n▁", "▁▁")
        return words.split("\n")

    def count(self, text: str) -> int:
        """Tokens of a text."""
        if not text:
            return 0
        segments, cache = self.segments(text), self.last_count
        try:
            tokens = sum(map(cache.__getitem__, segments))
        except KeyError:
            if len(cache) >= CACHE_ENTRIES:
                cache.clear()
            for s in segments:
                if s not in cache:
                    cache[s] = self._split_count(s)
            tokens = sum(map(cache.__getitem__, segments))
        return tokens + text.count("\n")

    def prefix_counts(self, text: str) -> list[int]:
        """Token counts of all prefixes of a text, one for each length in characters from 0 on."""
        counts, done, lead = [0], 0, len(self.prefix)
        for k, line in enumerate(text.split("\n")):
            if k:
                counts.append(done := done + 1)
            head = self.prefix if k == 0 else ""
            for segment in (s for s in re.findall("▁+[^▁]*|[^▁]+", head + line.replace(" ", "▁"))):
                table = self.table(segment)
                counts += [done + c for c in table[1:]]
                done += table[-1]
        counts = counts[lead:] if lead else counts
        if counts:
            counts[0] = 0  # the empty prefix gets no dummy space
        return counts

    def fits(self, text: str, budget: int) -> int:
        """Length in characters of the longest prefix of at most ``budget`` tokens."""
        counts = self.prefix_counts(text)
        return max(i for i, c in enumerate(counts) if c <= budget)


@lru_cache(maxsize=1)
def _counter(model_file: str) -> PrefixCounter:
    """One for each Python worker, so that its caches outlive a task."""
    return PrefixCounter(model_file)


def count_tokens(docs: DataFrame, model_file: str, limit: int = TOKEN_LIMIT, id_column: str = "doc_id", text_column: str = "text", with_prefixes: bool = False) -> DataFrame:
    """One row per document: its id, n_bytes, n_tokens, over_limit, and on request ``prefix_tokens``.

    ``prefix_tokens`` is the array of the token counts of all prefixes, by length in characters.
    A narrow map: no shuffle, and a lost task is just run again.
    """
    bound_batches(docs.sparkSession)
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_file)
        for batch in batches:
            n_bytes, n_tokens, prefixes = [], [], []
            for text in texts(batch.column(1)):
                n_bytes.append(len(text.encode("utf-8")))
                n_tokens.append(counter.count(text))
                if with_prefixes:
                    prefixes.append(counter.prefix_counts(text))
            columns = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())]
            names = [id_column, "n_bytes", "n_tokens", "over_limit"]
            if with_prefixes:
                columns, names = [*columns, pa.array(prefixes, pa.list_(pa.int32()))], [*names, "prefix_tokens"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_column}` {id_type}, n_bytes long, n_tokens long, over_limit boolean" + ", prefix_tokens array<int>" * with_prefixes
    return distinct_names(docs, id_column, text_column).mapInArrow(run, schema)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under piece_bpe_32k.model."""
    import public_tokenizers

    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
