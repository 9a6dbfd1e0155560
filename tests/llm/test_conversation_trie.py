import hashlib
import random
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest

from pairloom.llm import conversation_trie, time_forward


def brute(rows, shared_by=100):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - c % shared_by if shared_by else c
        rebuilt[c] = ts if base == c else own.get(base, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, cs in members.items():
        ended = ",".join(str(c) for c in sorted(cs) if len(rebuilt[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, shared_by=100):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "conv_id long, turn long, role string, text string, depth int, part int, i int")
    return sorted(map(tuple, conversation_trie.prefix_trie(df, shared_by).collect()), key=repr)


def sampled(seed):
    """Conversations with shared openings, one long one, and many equal ones; turns are told apart by their number."""
    r = random.Random(seed)
    rows = [(c, t, r.choice(["user", "assistant"]), r.choice(["a", "b", "ab", "é" * 5])) for c in range(230) for t in range(r.randint(1, 9))]
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1060) for t in range(4)]
    rows += [(777, t, "user", f"long {t % 3}") for t in range(150)] + [(700, t, "user", "x") for t in range(3)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("light", "band", "piece"), [(20_000, 4096, 1 << 16), (40, 4096, 20), (5, 3, 1 << 16), (1, 4, 30)])
def test_equals_brute_force(spark, monkeypatch, light, band, piece):
    """One shard; light subtrees and heavy nodes; heavy nodes in bands, so that totals cross band roots."""
    for name, value in (("LIGHT", light), ("PIECE", piece)):
        monkeypatch.setattr(conversation_trie, name, value)
    monkeypatch.setattr(conversation_trie.totals, "__defaults__", (band,))
    rows = sampled(light)
    assert found(spark, rows) == brute(rows)


def test_without_shared_openings(spark):
    rows = sampled(3)
    assert found(spark, rows, None) == brute(rows, None)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (2, None, "", ""), (None, 0, "user", "y"), (5, 3, "user", "w" * 30000), (-205, 1, "a", "b"), (-5, 1, "a", "b"), (-200, 1, "c", "d")]
    rows += [(100 + c, t, "user", "z") for c in range(1, 20) for t in range(2)]  # without a base: some have no turns left
    rebuilt = [(c if c is None or c > 0 else c, *r) for c, *r in rows]
    expected = brute([r for r in rebuilt if r[0] is None or r[0] > 0])
    assert found(spark, [r for r in rebuilt if r[0] is None or r[0] > 0]) == expected
    negative = found(spark, [r for r in rows if r[0] is not None and r[0] < 0])
    assert negative[0][3] >= 1  # openings of negative ids come from the multiple nearer to zero


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(5, 1, "user", "x")], [(100, 1, "user", "x")]])
def test_few_rows(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_queue_spills():
    r = random.Random(1)
    queue, expected = time_forward.SpillingQueue(10), []
    for step in range(300):
        for _ in range(r.randint(0, 30)):
            message = ((r.randint(step, step + 50), 0, 0), r.randint(0, 9), 1)
            queue.push(message)
            expected.append(message)
        got = list(queue.upto((step, 0, 0)))
        assert got == sorted(m for m in expected if m[0] <= (step, 0, 0))
        expected = [m for m in expected if m[0] > (step, 0, 0)]
    assert queue.runs > 20


def test_totals_do_not_depend_on_spilling():
    n = 2000
    up = [None, *[random.Random(k).randint(0, k - 1) for k in range(1, n)]]
    depth = [0] * n
    for k in range(1, n):
        depth[k] = depth[up[k]] + 1
    order = sorted(range(n), key=lambda k: (-depth[k], k))
    columns = [[0] * n, [depth[k] for k in order], order, [0] * n, [up[k] for k in order], [None if up[k] is None else 0 for k in order], [0] * n, [0] * n, [k % 7 for k in order]]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=list("abcdefghi"))
    several = [batch.slice(at, 300) for at in range(0, n, 300)]
    rows = [[r for b in time_forward.forward(iter(several), held) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)] for held in (3, 10**6)]
    assert rows[0] == rows[1]
    assert rows[0][-1][4] == sum(k not in set(up) for k in range(n)) and rows[0][-1][5] == sum(k % 7 for k in range(n))
