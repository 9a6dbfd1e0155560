import os
import re
from collections import Counter

import pytest

from pairloom.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows, inside = Counter(zip(words, words[1:], words[2:], strict=False)), set()
    for i in range(len(words) - 2):
        if windows[words[i], words[i + 1], words[i + 2]] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


@pytest.mark.parametrize("text", ["", "a\x0bb", "\x85 x \x1c y", "a a a a a", "a b c a b c a", "a\r\na\r\n \n\x1c\n\x1c", "# # #\n# # #", "é ü\né ü"])
def test_measures(text):
    assert quality.measures(text)[:5] == brute(text)


def test_query(spark, texts):
    from .conftest import DATA

    rows = quality.op10_quality_rules(spark, DATA).collect()
    assert {r["doc_id"]: tuple(r[1:6]) for r in rows} == {i: brute(t) for i, t in texts.items()}
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and r["p_good"] >= 0.5)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test data")
def test_verdicts_agree_with_held_out_labels(spark):
    """The fit sees no label; short texts may be labelled good and still fail the base rules."""
    folder = "/root/testdata/sf0.01"
    judged = quality.op10_quality_rules(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("NOT base_failed")
    right = judged.filter("kept = (quality = 1)").count()
    assert right >= 0.98 * judged.count()


def test_fit_tells_a_rare_kind_of_bad_text_from_good_ones():
    good, symbols = [1] * 8, [-1, 1, 1, 1, 1, 1, 1, 0]
    model = quality.fit([(good, 900), (symbols, 30), ([1, -1, -1, 1, 1, 1, 1, 1], 70), ([0] * 8, 5)])
    odds = lambda votes: sum(pro if v == 1 else con if v == -1 else 0 for v, (pro, con) in zip(votes, model, strict=True))
    assert odds(good) > 0 > odds(symbols)
    assert odds([0] * 8) == 0
    assert quality.fit([]) == [(0.0, 0.0)] * 8


def test_odd_rows(spark, odd):
    rows = {r["doc_id"]: r for r in quality.judged(quality.assess(odd), quality.learn(quality.assess(odd))).collect()}
    assert all(rows[i]["n_words"] == 0 and rows[i]["base_failed"] for i in (1, 2, 3))
    assert rows[4]["n_repeat_words"] == 20000
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns
    assert kept.count() == 0
    assert quality.keep_good(odd.limit(0)).count() == 0


def test_keep_good_keeps_rows_whole(spark, documents):
    from .conftest import DATA

    kept = {r["doc_id"] for r in quality.op10_quality_rules(spark, DATA).collect() if r["kept"]}
    rows = quality.keep_good(documents).collect()
    assert {r["doc_id"] for r in rows} == kept
    whole = {r["doc_id"]: r for r in documents.collect()}
    assert all(whole[r["doc_id"]] == r for r in rows)
