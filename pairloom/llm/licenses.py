"""Licence scan over a positional rare-token index (operator 8), in DataFrame functions only.

Templates are licence notices of one line and whole texts, a sentence a line, as names and years stand between sentences;
they are a table, and ``TEMPLATES`` are the ones that are taken where none is given. Each file is read once: the words that
templates know are kept with their places, and all else follows from these hits.

* How many files have each word is counted over all files. Of every sentence the words with the highest inverse document
  frequency make the index, as many as carry ``INDEX_SHARE`` of its weight.
* All files' index words are looked up first. Postings that agree on the distance between place in the file and place in
  the sentence are counted together. A sentence that stands somewhere with ``LEAST_SCORE`` of its weight lacks no more
  than the rest of it, so distances whose index words weigh too little can be left out without losing one.
* What is left is verified over all words of the sentence, and its mandatory key phrases must stand in it: each
  consecutively, at its aligned place or at most ``SHIFT`` words beside it. Key phrases are what a template differs in from
  its siblings (``gnu general public license`` is no part of the lesser one's name).
* A template is found if all its sentences with a key phrase are verified, and verified sentences make up ``LEAST_SCORE``
  of its weight, which is its score. Every template is looked up by itself, so what else a file holds changes nothing.

Words are runs of digits, A-Z taken as a-z, and all that is not ASCII; places count words from 0. Weights are whole
millionths, so sums don't depend on their order. Defined results: null and empty texts have no words and no label; very
long texts are read whole, and one that repeats a notice costs as much as the places it stands at; of equally frequent
words the first by name is taken; every row gets one row, repeated rows alike; an empty table gives an empty result, an
empty table of templates base labels alone; null ids are kept. Columns beyond id and text are not read. Of several licences
in one SPDX expression the first is sure to be named.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import starmap
from math import ceil, log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import cut_lineage, distinct_names, read_table

# Phrases that always count, with their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Label, notice, mandatory key phrases.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "version 2"]),
    ("gpl-3.0", "gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl-2.0", "gnu general public license version 2", ["gnu general public license", "version 2"]),
    ("gpl-3.0", "gnu general public license as published by the free software foundation version 3", ["gnu general public license", "version 3"]),
    ("gpl-2.0", "gnu general public license as published by the free software foundation version 2", ["gnu general public license", "version 2"]),
    ("lgpl", "gnu lesser general public license", ["lesser general public license"]),
    ("agpl", "gnu affero general public license", ["affero general public license"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ["permission is hereby granted free of charge"]),
    ("mit", "released under the mit license", ["the mit license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["redistribution and use in source and binary forms"]),
    ("bsd", "released under the bsd license", ["the bsd license"]),
    ("isc", "released under the isc license", ["the isc license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license", ["mozilla public license"]),
    ("mpl-2.0", "mozilla public license version 2 0", ["mozilla public license", "2 0"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]

# Identifiers of the SPDX list, as words.
SPDX = {
    "apache-2.0": "apache 2 0",
    "gpl-3.0": "gpl 3 0",
    "gpl-2.0": "gpl 2 0",
    "lgpl": "lgpl",
    "agpl": "agpl",
    "cc-by-4.0": "cc by 4 0",
    "cc-by-sa-4.0": "cc by sa 4 0",
    "cc-by-nc-4.0": "cc by nc 4 0",
    "mit": "mit",
    "bsd": "bsd",
    "isc": "isc",
    "mpl-2.0": "mpl 2 0",
    "unlicense": "unlicense",
}

# Whole texts, a sentence a line.
WHOLE = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
The Software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.
In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the Software or the use or other dealings in the Software.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
This software is provided by the copyright holders and contributors "as is" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed.
In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
The software is provided "as is" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness.
In no event shall the author be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software.""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and limitations under the License.""",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program.""",
    "gpl-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
See the GNU General Public License for more details.
You should have received a copy of the GNU General Public License along with this program.""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "unlicense": """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain.
We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors.
We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.
The software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.
In no event shall the authors be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.""",
}

# Mandatory key phrases of whole texts.
WHOLE_KEYS = {
    "mit": ["permission is hereby granted free of charge"],
    "bsd": ["redistribution and use in source and binary forms"],
    "isc": ["permission to use copy modify"],
    "apache-2.0": ["apache license", "version 2"],
    "gpl-3.0": ["gnu general public license", "version 3"],
    "gpl-2.0": ["gnu general public license", "version 2"],
    "mpl-2.0": ["mozilla public license", "2 0"],
    "unlicense": ["free and unencumbered software"],
}

#: (label, text, key phrases) of every template.
TEMPLATES = [
    *NOTICES,
    *((label, f"spdx license identifier {name}", [f"identifier {name}"]) for label, name in SPDX.items()),
    *((label, text, WHOLE_KEYS[label]) for label, text in WHOLE.items()),
]

#: Least share of the weight of a sentence at its place, and of a template in its sentences.
LEAST_SCORE = 0.6
#: Share of a sentence's weight in the index; above 1 - LEAST_SCORE, so that the index misses nothing.
INDEX_SHARE = 0.6
#: Words by which a key phrase may stand beside its aligned place.
SHIFT = 2
#: Words of all templates, which are broadcast.
MAX_WORDS = 1_000_000
_OTHER = "".join(c for c in map(chr, range(128)) if c not in string.digits + string.ascii_letters)


def words_of(text: str) -> list[str]:
    return text.translate(str.maketrans(string.ascii_uppercase + _OTHER, string.ascii_lowercase + " " * len(_OTHER))).split(" ")


@dataclass(frozen=True)
class Sentence:
    """A line of a template, and where its key phrases stand in it."""

    template: int
    words: tuple[str, ...]
    keys: tuple[tuple[str, int], ...]

    def weights(self, idf: dict[str, int]) -> int:
        return sum(idf[w] for w in self.words)

    def rare(self, idf: dict[str, int]) -> list[tuple[str, int]]:
        """Its rarest words, with all their places."""
        chosen, weight = set(), 0
        for w in sorted(set(self.words), key=lambda w: (-idf[w], w)):
            if weight >= INDEX_SHARE * self.weights(idf):
                break
            chosen.add(w)
            weight += idf[w] * self.words.count(w)
        return [(w, at) for at, w in enumerate(self.words) if w in chosen]

    def least(self, idf: dict[str, int]) -> int:
        """What the index words weigh at least where it reaches ``LEAST_SCORE``."""
        whole = self.weights(idf)
        return sum(idf[w] for w, _ in self.rare(idf)) - whole + ceil(LEAST_SCORE * whole)


def sentences(templates: Sequence[tuple[str, str, Sequence[str]]]) -> list[Sentence]:
    """Every template's lines; a key phrase belongs to the first line that holds it."""
    found = []
    for k, (label, text, keys) in enumerate(templates):
        lines = [words for line in text.split("\n") if (words := [w for w in words_of(line) if w])]
        own: list[list[tuple[str, int]]] = [[] for _ in lines]
        for key in map(str.split, keys):
            at = next(((n, i) for n, words in enumerate(lines) for i in range(len(words)) if words[i : i + len(key)] == key), None)
            if at is None:
                raise ValueError(f"{label}: key phrase {' '.join(key)} is not in its text")
            own[at[0]].append((" ".join(key), at[1]))
        found += [Sentence(k, tuple(words), tuple(at)) for words, at in zip(lines, own, strict=True)]
    if sum(len(s.words) for s in found) > MAX_WORDS:
        raise ValueError(f"templates have more than {MAX_WORDS} words")
    return found


def template_table(spark: SparkSession) -> DataFrame:
    """The own templates: (label, text, keys)."""
    return spark.createDataFrame(TEMPLATES, "label string, text string, keys array<string>")


def observed(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, _key, n_words, hits, places) for every row.

    ``hits`` are the words of the vocabulary with their places, ``places`` has the word places of each fixed phrase.
    """
    df = distinct_names(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    df = df.withColumn("_key", F.struct(F.xxhash64("_text").alias("a"), F.xxhash64("_text", F.lit(1)).alias("b")))
    plain = F.translate("_text", string.ascii_uppercase + _OTHER, string.ascii_lowercase + " " * len(_OTHER))
    df = df.withColumn("_words", F.array_remove(F.split(plain, " "), ""))
    known = F.transform("_words", lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("word"), i.alias("at"))))
    df = df.select("doc_id", "_key", F.size("_words").cast("long").alias("n_words"), F.filter(known, lambda h: h.isNotNull()).alias("hits"))
    return df.withColumn("places", F.array(*[_places(F.col("hits"), p) for p in PHRASES]))


def _places(hits: Column, phrase: str) -> Column:
    """Where a phrase's words stand consecutively."""
    first, *rest = phrase.split()

    def stands(hit: Column, j: Column) -> Column:
        ok = hit["word"] == first
        for k, w in enumerate(rest, 1):
            ok = ok & F.coalesce((F.get(hits, j + k)["word"] == w) & (F.get(hits, j + k)["at"] == hit["at"] + k), F.lit(False))
        return ok

    return F.filter(hits, stands)["at"]


def frequencies(found: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Inverse document frequency of every word in millionths, over all files; the driver gets one row for each."""
    own = F.array_distinct(F.col("hits")["word"])
    counts = found.select(F.explode(F.concat(own, F.array(F.lit("")))).alias("word")).groupBy("word").count()
    df = dict(map(tuple, counts.collect()))
    return {w: max(1, round(1e6 * log((df.get("", 0) + 2) / (df.get(w, 0) + 1)))) for w in vocabulary}


def matched(found: DataFrame, idf: dict[str, int], units: list[Sentence], labels: list[str]) -> DataFrame:
    """(_key, named, score): the licences found in each distinct text with an index word."""
    spark = found.sparkSession

    def table(rows: list[tuple], schema: str) -> DataFrame:  # all tables are of fixed size, MAX_WORDS rows at most
        return F.broadcast(spark.createDataFrame(rows, schema))

    index = [(w, k, at, idf[w]) for k, s in enumerate(units) for w, at in s.rare(idf)]
    rare = sorted({w for w, *_ in index})
    keys = sorted({key for s in units for key, _ in s.keys})
    postings = table(index, "word string, unit int, place int, weight long")
    least = table([(k, s.least(idf)) for k, s in enumerate(units)], "unit int, least long")
    every = table([(k, at, w, idf[w]) for k, s in enumerate(units) for at, w in enumerate(s.words)], "unit int, place int, word string, weight long")
    key_words = table([(w, n, at, len(key.split())) for n, key in enumerate(keys) for at, w in enumerate(key.split())], "word string, phrase int, place int, size long")
    key_places = table([(k, keys.index(key), at + by) for k, s in enumerate(units) for key, at in s.keys for by in range(-SHIFT, SHIFT + 1)], "unit int, phrase int, place int")
    asked = table([(k, s.template, s.weights(idf), len({key for key, _ in s.keys})) for k, s in enumerate(units)], "unit int, template int, whole long, n_keys long")
    own = [[s for s in units if s.template == t] for t in range(len(labels))]
    totals = table([(t, label, sum(s.weights(idf) for s in own[t]), sum(bool(s.keys) for s in own[t])) for t, label in enumerate(labels)], "template int, label string, total long, n_lines long")

    texts = cut_lineage(found.filter(F.exists("hits", lambda h: h["word"].isin(rare))).select("_key", "hits").dropDuplicates(["_key"]))
    hit = texts.select("_key", F.explode("hits").alias("h")).select("_key", "h.word", "h.at")
    aligned = hit.join(postings, "word").groupBy("_key", "unit", (F.col("at") - F.col("place")).alias("distance")).agg(F.sum("weight").alias("weight"))
    candidates = cut_lineage(aligned.join(least, "unit").filter(F.col("weight") >= F.col("least")).select("_key", "unit", "distance"))
    near = cut_lineage(hit.join(candidates.select("_key").distinct(), "_key", "left_semi"))

    place = F.col("distance") + F.col("place")
    expected = candidates.join(every, "unit").select("_key", "unit", "distance", place.alias("at"), "word", "weight")
    there = expected.join(near, ["_key", "at", "word"]).groupBy("_key", "unit", "distance").agg(F.sum("weight").alias("got"))
    phrases = near.join(key_words, "word").groupBy("_key", "phrase", "size", (F.col("at") - F.col("place")).alias("at")).count().filter(F.col("count") == F.col("size"))
    wanted = candidates.join(key_places, "unit").select("_key", "unit", "distance", "phrase", place.alias("at"))
    met = wanted.join(phrases.select("_key", "phrase", "at"), ["_key", "phrase", "at"]).groupBy("_key", "unit", "distance").agg(F.count_distinct("phrase").alias("met"))
    checked = there.join(asked, "unit").filter(F.col("got") >= LEAST_SCORE * F.col("whole")).join(met, ["_key", "unit", "distance"], "left")
    verified = checked.filter(F.coalesce("met", F.lit(0)) == F.col("n_keys")).groupBy("_key", "template", "unit").agg(F.max("got").alias("got"), F.max("n_keys").alias("n_keys"))
    scores = verified.groupBy("_key", "template").agg(F.sum("got").alias("got"), F.count_if(F.col("n_keys") > 0).alias("lines")).join(totals, "template")
    named = scores.filter((F.col("lines") == F.col("n_lines")) & (F.col("got") >= LEAST_SCORE * F.col("total")))
    return named.groupBy("_key").agg(F.collect_set("label").alias("named"), F.max(F.col("got") / F.col("total")).alias("score"))


def licenses(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_words, places, base_labels, labels, score) for every row; labels are sorted arrays.

    ``templates`` has columns label, text and keys (array of mandatory key phrases, none to ask for none); the driver reads
    it and refuses more than ``MAX_WORDS`` words.
    """
    table = TEMPLATES if templates is None else [(r["label"], r["text"], r["keys"] or []) for r in templates.select("label", "text", "keys").toLocalIterator()]
    units = sentences(table)
    vocabulary = sorted({w for s in units for w in s.words} | {w for p in PHRASES for w in p.split()})
    found = cut_lineage(observed(docs, vocabulary))
    idf = frequencies(found, vocabulary)
    named = cut_lineage(matched(found, idf, units, [label for label, *_ in table]))
    base = F.array_compact(F.array(*starmap(lambda k, label: F.when(F.size(F.col("places")[k]) > 0, F.lit(label)), enumerate(PHRASES.values()))))
    df = found.select("doc_id", "_key", "n_words", "places").join(named, "_key", "left").withColumn("base_labels", F.array_sort(base))
    own = F.coalesce("named", F.array().cast("array<string>"))
    score = F.greatest(F.coalesce("score", F.lit(0.0)), F.when(F.size("base_labels") > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return df.select("doc_id", "n_words", "places", "base_labels", F.array_sort(F.array_distinct(F.concat("base_labels", own))).alias("labels"), score.alias("score"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    every = F.flatten("places")
    return licenses(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )
