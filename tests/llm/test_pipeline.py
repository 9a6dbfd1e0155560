import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pairloom.llm import packing

from .conftest import CLASHING, DATA, ODD
from .test_pii import brute as private_brute
from .test_quality import brute as quality_brute
from .test_near_copies import check_copies
from .test_tokens import check_sequences

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def test_stages_one_by_one(spark, documents, tmp_path):
    docs = documents
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{k}")
        made = spark.read.parquet(f"{tmp_path}/{k}")
        before, after = docs.collect(), made.collect()
        if name != "packing":
            assert made.columns == documents.columns
        if name == "quality rules":
            for r in after:
                n, _, _, _, again = quality_brute(r["text"])
                assert n >= 50
                assert 2 * again <= n
            assert 0.6 * len(before) < len(after) < len(before)
        elif name == "near-duplicates":
            check_copies({r["doc_id"]: r["text"] for r in before}, {r["doc_id"] for r in after})
        elif name == "personal data":
            assert sum(private_brute(r["text"])[1] != "" for r in before) > 0
            assert all(private_brute(r["text"])[1] == "" for r in after)
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        elif name == "mixture":
            assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
            assert len(after) <= 1.6 * len(before)
        else:
            assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
            check_sequences(after)
        docs = made


def test_run(spark):
    rows = corpus_pipeline.run(spark, DATA).collect()
    check_sequences(rows)
    assert rows


def test_stages_take_odd_and_no_rows(spark, odd):
    """Extra columns of clashing names come back with their values; null ids, repeated rows and empty texts have defined results."""
    longer = [(50 + k, " ".join(f"w{k}x{i}" for i in range(120)) + " mail a@b.co now", "en", f"s{k % 2}", 5) for k in range(4)]
    extra = [c for c in odd.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    docs = odd.unionByName(spark.createDataFrame(longer, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(7) for c in extra})).cache()
    want = {"quality rules": [50, 51, 52, 53], "near-duplicates": [1, 4, 5, 6, 50, 51, 52, 53, None], "personal data": sorted([i for i, _ in ODD] + [50, 51, 52, 53], key=str), "mixture": None}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), DATA).count() == 0, name
        made = stage(spark, docs, DATA)
        rows = made.collect()
        if name == "packing":
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
            check_sequences(rows)
            continue
        assert made.columns == docs.columns, name
        assert all(r[c] == 7 for r in rows for c in extra), name
        if want[name] is not None:
            assert sorted((r["doc_id"] for r in rows), key=str) == sorted(want[name], key=str), name
        else:
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
        if name == "personal data":
            assert sum("[EMAIL]" in (r["text"] or "") for r in rows) == 4


def test_pieces_keep_columns_of_clashing_names(spark, odd):
    pieces = spark.createDataFrame([(k, 0, 0, 1 + k % 3, k) for k in range(20)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    made = packing.pack(pieces.withColumns({c: F.lit(7) for c in CLASHING if c not in pieces.columns}))
    rows = made.collect()
    assert made.columns == [*pieces.columns, *(c for c in CLASHING if c not in pieces.columns), "sequence_id", "offset"]
    assert len(rows) == 20
    assert all(r[c] == 7 for r in rows for c in CLASHING if c not in pieces.columns)
