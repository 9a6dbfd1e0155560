import random
import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from pairloom.llm import packing
from pairloom.llm.token_counts import PrefixCounter, count_tokens, op9_token_counts

MODEL, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(MODEL)


def random_texts(n, parts, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 50))) for _ in range(n)]


PARTS = [*"ab e\n▁ \t<s>é日本  .,😀\x00İ", "thing", "▁▁", "<unk>", "</s>", "ing ", "1.5"]


def test_counts_of_all_prefixes(library, counter):
    for t in random_texts(300, PARTS):
        assert counter.prefix_counts(t) == [len(library.encode(t[:i])) for i in range(len(t) + 1)]


def test_counts(library, counter):
    for t in [*random_texts(3000, PARTS, 2), "é" * 5000, "a" * 5000, " " * 3000, "日" * 2000]:
        assert counter.count(t) == len(library.encode(t))


def test_budget(library, counter):
    text = "The quick brown fox jumps over the lazy dog. " * 20
    for budget in (0, 1, 7, 50):
        n = counter.fits(text, budget)
        assert len(library.encode(text[:n])) <= budget
        assert all(len(library.encode(text[:k])) > budget for k in range(n + 1, min(n + 30, len(text))))


def test_query(spark, texts, library):
    from .conftest import DATA

    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in op9_token_counts(spark, DATA).collect()}
    assert got == {i: (len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t in texts.items()}


def test_odd_rows(spark, odd, library):
    rows = count_tokens(odd, MODEL, with_prefixes=True).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert (by[1]["n_tokens"], by[2]["n_tokens"], by[1]["prefix_tokens"]) == (0, 0, [0])
    assert by[4]["n_tokens"] == len(library.encode("word " * 20000)) == by[4]["prefix_tokens"][-1]
    assert count_tokens(odd.limit(0), MODEL).count() == 0


def test_word_ids():
    tokenizer, encoder = Tokenizer.from_file(WORDS), packing.WordEncoder(WORDS)
    parts = [*"abE É\n\t\x1c\xa0　'sʼ’Σς日̀é.,!9Ⅷİ", "<|endoftext|>", "don't", "THE.", "b9,", " Word, "]
    some = random_texts(4000, parts, 3)
    for t, ids in zip(some, encoder.encode(some), strict=True):
        assert ids == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_ids_of_odd_words():
    tokenizer, encoder = Tokenizer.from_file(WORDS), packing.WordEncoder(WORDS)
    odd = "H\u0331 T\u0344 É e\u0301 Ǆ ŉ İ. × a÷b ß, 'S it's'll !'s 12,5 a*** <|ENDOFTEXT|> X<|endoftext|>Y <| a\x0bb a\x1cb a\x85b </w>".split(" ")
    for some in ([w] for w in [*odd, " ".join(odd)]):
        assert encoder.encode(some) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in some]


@pytest.fixture
def counted(monkeypatch):
    """An encoder, and the words that reach the library."""
    encoder, reached = packing.WordEncoder(WORDS), []

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, some, **options):
            reached.extend(w for t in some for w in t.split())
            return self.tokenizer.encode_batch_fast(some, **options)

    for name, value in list(vars(encoder).items()):
        if isinstance(value, Tokenizer):
            monkeypatch.setattr(encoder, name, Counting(value))
    return encoder, reached


def test_words_of_known_runs_do_not_reach_the_library(counted):
    encoder, reached = counted
    encoder.encode(["alpha élan 's 1 2 5 , *** ( )"])
    assert reached
    reached.clear()
    assert [len(ids) > 0 for ids in encoder.encode(["Alpha*** (ALPHA) alpha's 12,5 élan***,"])] == [True]
    assert reached == ["***,"]


def test_words_in_use_outlive_a_full_cache(counted, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 100)
    encoder, reached = counted
    for k in range(50):
        encoder.encode(["alpha, beta " + " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + i)}q" for i in range(20))])
    assert [reached.count(w) for w in ("alpha", ",", "beta")] == [1, 1, 1]
    assert len(encoder.words) + len(encoder.older) <= 200


@pytest.mark.parametrize("capacity", [10, 50, 4096])
def test_plan_fills_sequences_without_gaps(capacity):
    rng = np.random.default_rng(capacity)
    for n in (0, 1, 5, 300):
        length = rng.choice([1, capacity // 3 or 1, capacity // 2, capacity, *range(1, min(capacity, 40))], n).astype(np.int64)
        segments = packing.plan({int(a): int(b) for a, b in zip(*np.unique(length, return_counts=True), strict=True)}, capacity)
        rank = np.array([(length[:i] == x).sum() for i, x in enumerate(length)], np.int64)
        if not n:
            assert len(segments) == 0
            continue
        sequence, offset = packing.place(segments, length, rank)
        for s in set(sequence):
            at = 0
            for o, x in sorted(zip(offset[sequence == s], length[sequence == s], strict=True)):
                assert o == at
                at += x
            assert at <= capacity
        large = 3 * length > capacity
        assert all((large & (sequence == s)).sum() <= 2 for s in set(sequence))
        assert len(set(sequence)) <= 1 + -(-11 * int(length.sum()) // (9 * capacity)) + n // 20


def test_packing_query(spark, texts):
    from .conftest import DATA

    tokenizer = Tokenizer.from_file(WORDS)
    rows = packing.op4_best_fit_packing(spark, DATA).collect()
    expected = set()
    for i, t in texts.items():
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k : k + 4096], "<u4").tobytes()
            expected.add((i, k // 4096, k, len(part) // 4, zlib.crc32(part)))
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == expected
    assert len(rows) == len(expected)
    check_sequences(rows)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 4096) + 3


def check_sequences(rows):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 4096


def test_packing_of_odd_rows(spark, odd):
    rows = packing.pack(packing.token_pieces(odd, WORDS, with_ids=True)).collect()
    assert sum(r["doc_id"] == 6 for r in rows) == 2
    assert [(r["length"], r["ids"]) for r in rows if r["doc_id"] == 1] == [(1, [1])]
    check_sequences(rows)
    assert packing.pack(packing.token_pieces(odd.limit(0), WORDS)).count() == 0
