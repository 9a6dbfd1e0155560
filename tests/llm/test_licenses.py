import math
import random
import re
import string
from collections import Counter

import pytest

from pairloom.llm import licenses


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def scanned(spark, docs, monkeypatch):
    monkeypatch.setattr(licenses, "read_table", lambda *a: docs)
    return licenses.op8_licenses(spark, "").collect()


def test_base_against_brute_force(spark, monkeypatch):
    rnd = random.Random(3)
    parts = ["cc", "CC", "by", "BY-NC", "-", "General", "public", "LICENSE", " ", "\n", "all", "rights", "Reserved", "é", "K", "x", "4.0", "licenſe", ". ", "_"]
    rows = {i: "".join(rnd.choice(parts) + rnd.choice([" ", "", "-"]) for _ in range(rnd.randint(0, 40))) for i in range(1500)}
    for r in scanned(spark, spark.createDataFrame(list(rows.items()), "doc_id long, text string"), monkeypatch):
        assert tuple(r[1:6]) == brute(rows[r["doc_id"]])
        assert 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def test_labels_of_notices(spark, monkeypatch):
    rows = {1: "x Licensed under the Apache License, Version 2.0. y", 2: "the GNU General Public License, version 3.", 3: "licensed under CC BY-NC 4.0.", 4: "apache foo license bar", 5: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"}
    rows |= {k: f"plain text number {k}" for k in range(10, 40)}
    got = {r["doc_id"]: r["labels"] for r in scanned(spark, spark.createDataFrame(list(rows.items()), "doc_id long, text string"), monkeypatch)}
    assert [got[k] for k in range(1, 6)] == ["apache-2.0", "gpl,gpl-3.0", "cc-by,cc-by-nc-4.0", "", "mit"]
    assert {got[k] for k in range(10, 40)} == {""}


def test_no_notice_pushes_out_another(spark):
    """Also where the words of one are in many more files than those of the others."""
    notices = {label: notice for label, notice, _ in reversed(licenses.NOTICES)}
    every = " and ".join(f"x {n}" for n in notices.values())
    rows = [(1, " x ".join(notices[k] for k in ("mit", "bsd", "unlicense"))), (2, every)]
    rows += [(10 + k, "permission hereby granted obtaining software") for k in range(30)]
    got = {r["doc_id"]: set(r["labels"]) for r in licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == {"mit", "bsd", "unlicense"}
    assert got[2] >= set(notices)
    assert got[10] == set()


def test_every_pair_of_whole_texts_is_named(spark):
    """With names and years in them, and a word of the second line changed."""
    def copy(label):
        first, second, *rest = licenses.WHOLE[label].split("\n")
        second = " ".join("changed" if k == 2 else w for k, w in enumerate(second.split()))
        return "\n".join([first, "by A. Person, 2019", second, *rest])

    pairs = [(a, b) for a in licenses.WHOLE for b in licenses.WHOLE if a < b]
    rows = [(k, f"{copy(a)}\n\nand\n\n{copy(b)}") for k, (a, b) in enumerate(pairs)] + [(1000 + k, f"plain text of number {k} without any of it") for k in range(30)]
    got = {r["doc_id"]: set(r["labels"]) for r in licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (a, b) in enumerate(pairs):
        assert {a, b} <= got[k]
    assert {tuple(got[1000 + k]) for k in range(30)} == {()}


def test_no_python_on_the_way(spark, odd):
    units = licenses.sentences(licenses.TEMPLATES)
    vocabulary = sorted({w for s in units for w in s.words})
    found = licenses.observed(odd, vocabulary)
    labels = [label for label, *_ in licenses.TEMPLATES]
    assert "Python" not in licenses.matched(found, dict.fromkeys(vocabulary, 1), units, labels)._jdf.queryExecution().toString()


def plain_labels(texts, templates):
    """Labels and score of every text: each sentence at every place, over plain lists."""
    files = [licenses.words_of(t) for t in texts]
    files = [[w for w in words if w] for words in files]
    units = licenses.sentences(templates)
    df = Counter(w for words in files for w in set(words))
    idf = {w: max(1, round(1e6 * math.log((len(files) + 2) / (df[w] + 1)))) for s in units for w in s.words}
    for words in files:
        best = [0] * len(units)
        for k, s in enumerate(units):
            whole = sum(idf[w] for w in s.words)
            for d in range(-len(s.words), len(words)):
                got = sum(idf[w] for i, w in enumerate(s.words) if 0 <= d + i < len(words) and words[d + i] == w)
                stands = lambda key, at: any(words[i : i + len(key.split())] == key.split() for i in range(max(0, at - licenses.SHIFT), at + licenses.SHIFT + 1))
                if got >= licenses.LEAST_SCORE * whole and all(stands(key, d + at) for key, at in s.keys):
                    best[k] = max(best[k], got)
        named, score = set(), 0.0
        for t, (label, *_) in enumerate(templates):
            own = [k for k, s in enumerate(units) if s.template == t]
            total = sum(idf[w] for k in own for w in units[k].words)
            if all(best[k] for k in own if units[k].keys) and sum(best[k] for k in own) >= licenses.LEAST_SCORE * total:
                named.add(label)
                score = max(score, sum(best[k] for k in own) / total)
        yield named, score


def test_labels_and_score_against_a_plain_matcher(spark):
    """Pieces of all templates with words lost, added, changed and moved, in files of their own and together."""
    rnd = random.Random(4)
    lines = [line for _, text, _ in licenses.TEMPLATES for line in text.split("\n")]

    def piece():
        words = rnd.choice(lines).split()
        for _ in range(rnd.choice([0, 0, 1, 2, 6])):
            at = rnd.randrange(len(words))
            words[at : at + rnd.choice([0, 1, 1])] = rnd.choices(["version", "3", "2", "gnu", "lesser", "foo", "license"], k=rnd.choice([0, 1, 1, 2]))
            words = words or ["x"]
        return " ".join(words)

    texts = ["\n".join(piece() for _ in range(rnd.choice([0, 1, 1, 2, 5]))) for _ in range(250)] + [text for _, text, _ in licenses.TEMPLATES]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.licenses(docs).collect()}
    seen = set()
    for k, (named, score) in enumerate(plain_labels(texts, licenses.TEMPLATES)):
        assert set(got[k]["labels"]) - set(got[k]["base_labels"]) == named, texts[k]
        if not got[k]["base_labels"]:
            assert abs(got[k]["score"] - score) < 1e-12
        seen |= named
    assert seen == {label for label, *_ in licenses.TEMPLATES}


HEADER = "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free Software Foundation, {2}"
REST = "\nThis {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.\nSee the GNU {1}General Public License for more details.\nYou should have received a copy of the GNU {1}General Public License along with this {0}."
EITHER = "either version {0} of the License, or (at your option) any later version."


def test_siblings_are_told_apart(spark):
    """One by one, and every pair in one file."""
    siblings = [
        (HEADER.format("program", "", EITHER.format(3)) + REST.format("program", ""), {"gpl", "gpl-3.0"}),
        (HEADER.format("program", "", EITHER.format(2)) + REST.format("program", ""), {"gpl", "gpl-2.0"}),
        (HEADER.format("program", "", "version 3."), {"gpl", "gpl-3.0"}),
        (HEADER.format("program", "", "version 2."), {"gpl", "gpl-2.0"}),
        (HEADER.format("library", "Lesser ", EITHER.format(3)) + REST.format("library", "Lesser "), {"gpl", "lgpl"}),
        (HEADER.format("library", "Lesser ", EITHER.format("2.1")) + REST.format("library", "Lesser "), {"gpl", "lgpl"}),
        (HEADER.format("program", "Affero ", EITHER.format(3)) + REST.format("program", "Affero "), {"gpl", "agpl"}),
        ("Licensed under CC BY 4.0.", {"cc-by", "cc-by-4.0"}),
        ("Licensed under CC BY-SA 4.0.", {"cc-by", "cc-by-sa-4.0"}),
        ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc-4.0"}),
        ("Licensed under CC BY-NC-SA 4.0.", {"cc-by"}),
        ("Licensed under the Apache License, Version 2.0.", {"apache-2.0"}),
        ("Licensed under the Apache License, Version 1.1.", set()),
        ("Released under the MIT License.", {"mit"}),
        ("Released under the BSD license.", {"bsd"}),
        *((f"// SPDX-License-Identifier: {name.replace(' ', '-')}", {label} | ({"cc-by"} if "cc by" in name else set())) for label, name in licenses.SPDX.items()),
        ("SPDX-License-Identifier: LGPL-2.1-only", {"lgpl"}),
        ("SPDX-License-Identifier: Zlib", set()),
    ]
    pairs = [(a, b) for a in range(len(siblings)) for b in range(a)]
    rows = [(k, text) for k, (text, _) in enumerate(siblings)] + [(1000 + k, f"{siblings[a][0]}\n\nThe other part of it comes from elsewhere\n\n{siblings[b][0]}") for k, (a, b) in enumerate(pairs)]
    rows += [(9000 + k, f"plain text of number {k}") for k in range(300)]
    got = {r["doc_id"]: set(r["labels"]) for r in licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (text, labels) in enumerate(siblings):
        assert got[k] == labels, text
    for k, (a, b) in enumerate(pairs):
        assert got[1000 + k] == siblings[a][1] | siblings[b][1], (siblings[a][0], siblings[b][0])


def test_templates_as_a_table(spark):
    docs = spark.createDataFrame([(1, "use it as you like, but call us"), (2, "use it as you like"), (3, "Released under the MIT License"), *((k, f"text {k}") for k in range(10, 30))], "doc_id long, text string")
    own = spark.createDataFrame([("house", "Use it as you like,\nbut call us first", ["call us"]), ("free", "use it as you like", None)], "label string, text string, keys array<string>")
    got = {r["doc_id"]: r["labels"] for r in licenses.licenses(docs, own).collect()}
    assert (got[1], got[2], got[3]) == (["free", "house"], ["free"], [])
    assert {tuple(r["labels"]) for r in licenses.licenses(docs, own.limit(0)).collect()} == {()}
    with pytest.raises(ValueError, match="key phrase"):
        licenses.sentences([("a", "some text", ["other text"])])


def test_one_file_of_many_notices(spark):
    rows = [(1, "Released under the MIT License. " * 20000), (2, "license " * 50000), *((k, f"text {k}") for k in range(10, 30))]
    got = {r["doc_id"]: r for r in licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["labels"], got[1]["n_words"], got[2]["labels"]) == (["mit"], 100000, [])


def test_query(spark, texts):
    from .conftest import DATA

    for r in licenses.op8_licenses(spark, DATA).collect():
        assert tuple(r[1:6]) == brute(texts[r["doc_id"]])


def test_odd_rows(spark, odd):
    rows = licenses.licenses(odd).collect()
    assert len(rows) == odd.count()
    assert {r["n_words"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
    assert licenses.licenses(odd.limit(0)).count() == 0


def test_copies_do_not_change_a_score(spark):
    rows = [(k, "Licensed under the Apache License, Version 2.0") for k in range(50)] + [(99, "nothing")]
    got = licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["score"] for r in got if r["doc_id"] < 50} == {1.0}
    assert len(got) == 51
