import math
import random

import numpy as np
import pytest

from pairloom.llm import near_copies
from pairloom.llm.simhash import keep_one


def shingles(text):
    words = (text or "").lower().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def jaccard(a, b):
    return len(a & b) / max(1, len(a | b))


def check_copies(texts, kept):
    """Of equal texts the least id stays; of near copies hardly any two; what is like no other text stays."""
    first = {}
    for i in sorted(texts):
        first.setdefault(texts[i], i)
    assert kept <= set(first.values())
    sets = {i: shingles(t) for t, i in first.items()}
    ids, best, near, caught = sorted(sets), dict.fromkeys(sets, 0.0), 0, 0
    for k, a in enumerate(ids):
        for b in ids[:k]:
            j = jaccard(sets[a], sets[b])
            best[a], best[b] = max(best[a], j), max(best[b], j)
            if j >= 0.8:
                near += 1
                caught += a not in kept or b not in kept
    assert caught >= 0.95 * near
    assert {i for i in ids if best[i] < 0.5} <= kept


def corpus(seed=1):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(4000)]
    texts = {}
    for _ in range(60):
        base = [rnd.choice(words) for _ in range(rnd.choice([60, 200, 1500]))]
        texts[len(texts)] = " ".join(base)
        for _ in range(rnd.choice([0, 0, 1, 4])):
            copy = [rnd.choice(words) if rnd.random() < 0.015 else w for w in base]
            texts[len(texts)] = " ".join(copy)
        if rnd.random() < 0.3:
            texts[len(texts)] = " ".join(base)
    return texts


@pytest.mark.parametrize(("limit", "meeting"), [(8192, 2000), (3, 2000), (8192, 3)])
def test_planted_copies(spark, monkeypatch, limit, meeting):
    """The same groups where buckets and groups of candidates are cut."""
    monkeypatch.setattr(near_copies, "BUCKET_LIMIT", limit)
    monkeypatch.setattr(near_copies, "MEETING", meeting)
    texts = corpus()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r["doc_id"] for r in keep_one(docs, near_copies.near_copies(docs)).collect()}
    check_copies(texts, kept)
    sets = {i: shingles(t) for i, t in texts.items()}
    assert all(i in kept or any(j != i and jaccard(sets[i], sets[j]) > 0.5 for j in texts) for i in texts)


def test_index_finds_what_brute_force_finds():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, (30, 4), dtype=np.uint64)
    noise = np.packbits(rng.random((30, 12, 256)) < 0.12, axis=2).view(np.uint64).reshape(30, 12, 4)
    values = np.concatenate([base, (base[:, None, :] ^ noise).reshape(-1, 4)])
    key = rng.integers(0, 5, len(values))
    order = np.lexsort((values[:, 0], key))
    values, key = values[order], key[order]
    label = near_copies.stars(values, np.flatnonzero(np.append(True, key[1:] != key[:-1])), 44)
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if key[i] == key[j] and np.bitwise_count(values[i] ^ values[j]).sum() <= 44:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert label.tolist() == [find(i) for i in range(len(values))]


def test_hot_buckets_lose_no_pair(spark, monkeypatch):
    """The fingerprints agree in one block of the last word alone; two of them differ in 32 of the compared bits, those of two halves in 4 more."""
    monkeypatch.setattr(near_copies, "BUCKET_LIMIT", 4)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 16, 16, dtype=np.uint16)
    wide = rng.integers(0, 1 << 16, (14, 4 * near_copies.WORDS), dtype=np.uint16)
    wide[:, :16] = base ^ (np.uint16(1) << np.arange(14, dtype=np.uint16))[:, None]
    wide[:, -1] = 7
    wide[7:, :2] ^= np.uint16(3 << 14)
    fps = spark.createDataFrame([(k, k, bytearray(w.tobytes())) for k, w in enumerate(wide)], "node long, comp long, fp binary")
    monkeypatch.setattr(near_copies, "bit_limit", lambda similarity: 44)
    edges = near_copies.candidates(fps, 0.8).collect()
    groups = {k: {k} for k in range(14)}
    for e in edges:
        both = groups[e["a"]] | groups[e["b"]]
        groups |= dict.fromkeys(both, both)
    assert groups[0] == set(range(14))


def test_exact_links_against_all_pairs():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, (6, 200), dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(200) < rng.choice([0.0, 0.05, 0.12]), rng.integers(0, 2**63, 200, dtype=np.uint64), base[k % 6])) for k in range(90)] + [np.zeros(0, np.uint64)] * 2
    group = np.arange(92)
    group[6:12] = group[0:6]
    a, b = near_copies.exact_links(sets, group, 0.8)
    label = near_copies.joined(near_copies.firsts(group), a, b)
    want = near_copies.firsts(group)
    for i in range(92):
        for j in range(i):
            if len(sets[i]) and len(sets[j]) and len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])):
                want = near_copies.joined(want, np.array([i]), np.array([j]))
    assert (label == want).all()
    assert all(len(np.intersect1d(sets[x], sets[y])) >= 0.8 * len(np.union1d(sets[x], sets[y])) for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("n", [1000, 1 << 26, 1 << 30])
def test_wider_blocks_miss_no_more(n):
    """Bits of pairs at the similarity agree independently by the angle; the share of pairs without a common block."""
    rng, blocks = np.random.default_rng(1), near_copies.block_plan(n)
    differ = rng.random((4000, 640)) < math.acos(2 * 0.8 / 1.8) / math.pi
    missed = 1 - np.any([~differ[:, b].any(axis=1) for b in blocks], axis=0).mean()
    assert missed < 0.08
    assert n / 2.0 ** len(blocks[0]) <= 2 * near_copies.BUCKET_MEAN


def test_pairs_at_the_similarity_are_confirmed_exactly(spark):
    """Of pairs just above it hardly any is lost to the limit of bits; none below it is linked."""
    rnd, texts = random.Random(4), {}
    for k in range(160):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
        copy, changes = list(base), 8 if k < 80 else 11  # each takes five shingles of 396: 0.82 and 0.76
        for c in range(changes):
            copy[20 + 30 * c] = "other"
        texts |= {2 * k: " ".join(base), 2 * k + 1: " ".join(copy)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_copies.near_copies(docs).collect()}
    above = [jaccard(shingles(texts[2 * k]), shingles(texts[2 * k + 1])) >= 0.8 for k in range(160)]
    assert above == [k < 80 for k in range(160)]
    linked = [got[2 * k + 1] == 2 * k for k in range(160)]
    assert sum(linked[:80]) >= 75
    assert not any(linked[80:])


def test_unlike_texts_of_one_id_stay(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(1, text(1)), (2, text(1)), (2, text(2)), (3, text(3)), (3, text(4)), (3, text(4)), (4, text(4)), (5, text(5)), (5, text(5) + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r["doc_id"], r["text"]) for r in keep_one(docs, near_copies.near_copies(docs)).collect())
    assert kept[:4] == [(1, text(1)), (2, text(2)), (3, text(3)), (3, text(4))]
    assert [i for i, _ in kept[4:]] == [5]


def test_odd_rows(spark, odd):
    rows = near_copies.near_copies(odd).collect()
    assert len(rows) == odd.count()
    by = {(r["doc_id"], r["component_id"]) for r in rows}
    assert {(1, 1), (2, 1), (3, 1), (6, 6), (7, 6), (None, None)} <= by
    assert near_copies.near_copies(odd.limit(0)).count() == 0
