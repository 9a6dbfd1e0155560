import re

import numpy as np
import pytest
import xxhash

from pairloom.llm import simhash
from pairloom.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Least id reachable, from {id: fingerprint}."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[:k]:
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", ["", None, "a", "A b", "É\x85x y z\x1cw", "a b c d e f", "the cat " * 700])
def test_fingerprint(text):
    assert simhash.fingerprint(text or "") == brute_fingerprint(text)


def test_query(spark, texts):
    from .conftest import DATA

    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op1_simhash(spark, DATA).collect()}
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    roots = brute_components(prints)
    assert got == {i: (f"{p:016x}", roots[i]) for i, p in prints.items()}


@pytest.mark.parametrize("limit", [2, 2048])
def test_links_of_a_ball_a_chain_and_random_ones(spark, limit):
    """Small buckets are dealt again, up to the last round."""
    rng = np.random.default_rng(1)
    center = int(rng.integers(0, 2**63))
    ball = {center ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in range(150)}
    chain, x = [], int(rng.integers(0, 2**63))
    for k in range(60):
        x ^= 1 << (k * 7 % 64) | 1 << (k * 11 % 64)
        chain.append(x)
    every = sorted(ball | set(chain) | {0, 2**64 - 1} | {int(r) for r in rng.integers(0, 2**63, 100)})
    fps = spark.createDataFrame([(simhash._signed(f),) for f in every], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.fingerprint_links(fps, bucket_limit=limit)).collect()}
    roots = brute_components(dict(enumerate(every)))
    groups, expected = {}, {}
    for k, f in enumerate(every):
        groups.setdefault(got.get(simhash._signed(f), simhash._signed(f)), set()).add(f)
        expected.setdefault(roots[k], set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_blocks_cover_all_bits():
    for mask in (0, *simhash.blocks(0), *simhash.blocks(simhash.blocks(0)[1])):
        parts = [m ^ mask for m in simhash.blocks(mask)]
        assert sum(parts) | mask == 2**64 - 1
        assert sum(p.bit_count() for p in parts) + mask.bit_count() == 64


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (130, 101)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 131)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark, odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["fp"], r["component_id"]))
    assert by[1] == by[2] == by[3] == {(0, 1)}
    assert {c for _, c in by[6] | by[7]} == {6}
    assert [c for _, c in by[None]] == [None]
    kept = simhash.keep_one(odd, simhash.near_duplicates(odd))
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 4, 5, 6]
    assert kept.columns == odd.columns
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
