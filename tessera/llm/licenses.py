"""Licence scan, in DataFrame operations only: TF-IDF cosine to templates, then
inheritance from the nearest ancestor directory.

Texts are compared with templates in two ways, both as sparse TF-IDF vectors
whose document frequencies are counted over all files:

* a *header* template with windows of as many consecutive words, wherever the
  lines break. A window that reaches the cosine holds one of the template's
  heaviest terms (its necessary prefix: what is left is too short a vector), so
  only windows that line up with such a term are weighed, at every place of the
  whole text;
* a *full text* template with the file as a whole.

A file that is a licence text as a whole, or that opens with the head of one, or
that is mostly licence notices is the licence file of its directory. Files
without a licence of their own take that of their nearest ancestor directory
that has one, by an equi-join on paths. SPDX identifiers are read as they stand.
"""

from __future__ import annotations

from functools import reduce
from math import log, sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.scratch import Scratch

# Notices as the licences themselves ask for them, and lines that
# commonly stand in files, as (licence, text).
HEADERS = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This file is licensed under the MIT License, see LICENSE for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("Proprietary", "All rights reserved."),
)
# How long licence texts begin.
OPENINGS = (
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
)
# Licence texts that are short, whole, without the copyright line.
FULL_TEXTS = (
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
    rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
    permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
    notice and this permission notice shall be included in all copies or substantial portions of the Software. THE
    SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
    WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
    COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
    OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
    this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
    distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
    promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY
    THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
    THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
    COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
    DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
    BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
    (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
    POSSIBILITY OF SUCH DAMAGE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
    provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS
    IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
    MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
    DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
    NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
)
COSINE = 0.8
#: Share of a file's words in licence windows that makes it a licence file, and
#: words before the head of a licence text that opens a file.
FILE_SHARE = 0.5
OPENING_WORDS = 40
_BREAK = r"[^a-z0-9]+"
_SPDX = r"(?i)SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]*[A-Za-z0-9+])"


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _BREAK), lambda w: w != "")


def _plain_terms(text: str) -> list[str]:
    out, word = [], ""
    for c in text.lower() + " ":
        if "a" <= c <= "z" or "0" <= c <= "9":
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def _vector(words: list[str], idf: dict[str, float]) -> dict[str, float]:
    """The unit vector of a template, or nothing."""
    weights: dict[str, float] = {}
    for w in words:
        weights[w] = weights.get(w, 0) + idf[w]
    norm = sqrt(sum(v * v for v in weights.values()))
    return {w: v / norm for w, v in weights.items()} if norm else {}


def _fixed_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A small table of literals."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in r.items()]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _prefix(vector: dict[str, float], cosine: float) -> list[str]:
    """Heaviest terms, so many that the others alone can't reach the cosine."""
    rest, out = 1.0, []
    for term, weight in sorted(vector.items(), key=lambda x: (-x[1], x[0])):
        if sqrt(max(0.0, rest)) < cosine - 1e-9:
            break
        out.append(term)
        rest -= weight * weight
    return out


def _cosines(spans: DataFrame, keys: list[str], weights: DataFrame, entries: DataFrame, unseen: float) -> DataFrame:
    """(keys, score) of ``spans`` (keys with ``template``, words): each span's
    cosine with its template."""
    counted = spans.select(*keys, F.explode("words").alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))
    weighed = counted.join(F.broadcast(weights), "term", "left").withColumn("weight", F.col("tf") * F.coalesce("idf", F.lit(unseen)))
    weighed = weighed.join(F.broadcast(entries), ["template", "term"], "left")  # the templates' terms: a fixed table
    dot, norm = F.sum(F.col("weight") * F.col("part")), F.sqrt(F.sum(F.col("weight") * F.col("weight")))
    return weighed.groupBy(*keys).agg(F.round(dot / norm, 9).alias("score"))


def own_licences(files: DataFrame, scratch: Scratch, headers=HEADERS, openings=OPENINGS, full_texts=FULL_TEXTS, cosine: float = COSINE, file_share: float = FILE_SHARE) -> DataFrame:
    """(path, licence, score, licence_file) of the ``files`` (path, text) that
    hold a licence themselves."""
    spark = files.sparkSession
    found = [("header", *x) for x in headers] + [("opening", *x) for x in openings] + [("full", *x) for x in full_texts]
    words = [_plain_terms(text) for _, _, text in found]
    vocabulary = sorted({w for x in words for w in x})
    known = F.array_intersect(F.array_distinct(terms(F.col("text"))), F.array(*map(F.lit, vocabulary)))
    held = files.select(F.explode_outer(known).alias("term")).groupBy("term").agg(F.count("*").alias("n")) if vocabulary else None
    total, counts = files.count(), {r["term"]: r["n"] for r in held.collect()} if vocabulary else {}  # a row per template term
    idf = {w: log((total + 1) / (counts.get(w, 0) + 1)) + 1 for w in vocabulary}
    unseen = log(total + 1) + 1  # of words that no template holds
    vectors = [_vector(x, idf) for x in words]
    weights = _fixed_rows(spark, [{"term": w, "idf": idf[w]} for w in vocabulary] or [{"term": "", "idf": 0.0}])
    entries = _fixed_rows(spark, [{"template": k, "term": w, "part": x} for k, v in enumerate(vectors) for w, x in v.items()] or [{"template": -1, "term": "", "part": 0.0}])
    # each template's heaviest terms, and where they stand in it
    heaviest = [(w, k) for k, v in enumerate(vectors) for w in _prefix(v, cosine)]
    headed = {(w, k): [i for i, x in enumerate(words[k]) if x == w] for w, k in heaviest if found[k][0] != "full"}
    full = [(w, k) for w, k in heaviest if found[k][0] == "full"]
    anchor_terms = sorted({w for w, _ in heaviest})
    none = r"(?!)"
    any_anchor = F.rlike(F.lower("text"), F.lit(r"(?<![a-z0-9])(?:" + "|".join(anchor_terms) + r")(?![a-z0-9])" if anchor_terms else none))
    spdx = F.regexp_extract("text", _SPDX, 1)
    split = F.when(any_anchor, terms(F.col("text"))).otherwise(F.array().cast("array<string>"))
    candidates = files.where(any_anchor | (spdx != "")).select(F.monotonically_increasing_id().alias("file"), "path", spdx.alias("spdx"), split.alias("words"))
    places = F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    here = F.filter(places, lambda x: x["w"].isin(sorted({w for w, _ in headed})))
    candidates = scratch.table(candidates.withColumns({"n_words": F.size("words"), "here": here}), "candidates")

    # windows that line up with such a term; a file's words go on only inside them
    here = F.col("here")
    def lined_up(term: str, template: int, places: list[int]) -> Column:
        begins = lambda x: F.array(*[F.greatest(F.lit(0), x["i"] - F.lit(j)) for j in places])
        firsts = F.flatten(F.transform(F.filter(here, lambda x: x["w"] == term), begins))
        return F.transform(firsts, lambda i: F.struct(F.lit(template).alias("template"), i.alias("first"), F.lit(len(words[template])).alias("n")))

    lists = [lined_up(w, k, at) for (w, k), at in headed.items()]
    spans = []
    if lists:
        windows = candidates.select("file", "words", F.explode(F.array_distinct(F.concat(*lists))).alias("p"))
        spans.append(windows.select("file", "p.template", "p.first", F.slice("words", F.col("p.first") + 1, F.col("p.n")).alias("words")))
    if full:
        wholes = F.array_distinct(F.concat(*[F.when(F.array_contains("words", w), F.array(F.lit(k))).otherwise(F.array().cast("array<int>")) for w, k in full]))
        spans.append(candidates.select("file", F.explode(wholes).alias("template"), F.lit(0).alias("first"), "words"))
    if not spans:
        spans.append(candidates.where("false").select("file", F.lit(-1).alias("template"), F.lit(0).alias("first"), "words"))
    spans = reduce(DataFrame.unionByName, spans)
    scored = _cosines(spans, ["file", "template", "first"], weights, entries, unseen).where(F.col("score") >= cosine)
    kinds = _fixed_rows(spark, [{"template": k, "kind": kind, "licence": name, "n": len(words[k])} for k, (kind, name, _) in enumerate(found)] or [{"template": -1, "kind": "", "licence": "", "n": 0}])
    scored = scratch.table(scored.join(F.broadcast(kinds), "template"), "licence-windows")

    # words inside licence windows: those that a window adds to the windows that begin before it
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
    grown = lambda s, x: F.struct(F.greatest(s["upto"], x["end"]).alias("upto"), (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["upto"], x["first"]))).alias("n"))
    covered = F.aggregate("spans", zero, grown, lambda s: s["n"])
    best = F.max_by(F.struct("licence", "score"), F.struct("score", (-F.col("first")).alias("f"), (-F.col("template")).alias("t")))
    windows = scored.groupBy("file").agg(
        best.alias("b"),
        F.collect_set(F.when(F.col("kind") != "full", F.struct("first", (F.col("first") + F.col("n")).alias("end")))).alias("spans"),
        F.bool_or((F.col("kind") == "full") | ((F.col("kind") == "opening") & (F.col("first") <= OPENING_WORDS))).alias("text_of_licence"),
    )
    windows = windows.withColumn("spans", F.array_sort("spans")).select("file", "b", covered.alias("licence_words"), "text_of_licence")
    whole = F.col("text_of_licence") | (F.col("licence_words") >= file_share * F.col("n_words"))
    own = candidates.select("file", "path", "spdx", "n_words").join(windows, "file", "left").where("spdx <> '' OR b IS NOT NULL")
    named = F.col("spdx") != ""
    return own.select(
        "path",
        F.when(named, F.col("spdx")).otherwise(F.col("b.licence")).alias("licence"),
        F.when(named, F.lit(1.0)).otherwise(F.col("b.score")).alias("score"),
        F.coalesce(whole, F.lit(False)).alias("licence_file"),
    )


def ancestors(path: Column) -> Column:
    """The directories above a path, the nearest first, the root (empty) last."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))


def scan_licences(files: DataFrame, headers=HEADERS, openings=OPENINGS, full_texts=FULL_TEXTS, cosine: float = COSINE, file_share: float = FILE_SHARE) -> DataFrame:
    """One row per row of ``files`` (path, text): path, licence (own, else
    inherited, else null), score (the cosine of its window or text, 1 for an SPDX
    identifier, own only), how (``own``, ``inherited`` or null), source_dir (the
    directory it was inherited from), licence_file (whether the file is one).

    Null and empty texts have no licence of their own; whole texts are scanned,
    line breaks count as any white space. An SPDX identifier (the first) goes
    before windows; of these the best counts, of equal ones the first. A
    directory with several licence files takes the one with the best score, of
    equal ones the smallest path. Paths are relative, parted by /, and distinct
    but for repeated rows, which each get the result; a null one has no licence.
    Other columns are ignored; an empty table gives an empty result.
    """
    with Scratch(files.sparkSession) as scratch:
        source = files.select(F.col("path").cast("string").alias("path"), F.coalesce("text", F.lit("")).alias("text"))
        own = own_licences(source.where("path is not null"), scratch, headers, openings, full_texts, cosine, file_share)
        own = scratch.table(own.groupBy("path").agg(F.max_by(F.struct("licence", "score", "licence_file"), "score").alias("o")).select("path", "o.*"), "own-licences")
        placed = own.where("licence_file").select(F.regexp_extract("path", r"(?s)^(?:(.*)/)?[^/]*$", 1).alias("dir"), "path", "licence", "score")
        nearest = placed.groupBy("dir").agg(F.max("score").alias("score")).join(placed, ["dir", "score"])
        nearest = scratch.table(nearest.groupBy("dir").agg(F.min_by("licence", "path").alias("dir_licence")), "directories")
        bare = source.select("path").join(own.select("path"), "path", "left_anti")
        above = bare.select("path", F.posexplode(ancestors(F.col("path"))).alias("steps", "dir"))
        inherited = above.join(nearest, "dir").groupBy("path").agg(F.min_by(F.struct("dir_licence", "dir"), "steps").alias("n"))
        result = (
            source.select("path")
            .join(own, "path", "left")
            .join(inherited, "path", "left")
            .select(
                "path",
                F.coalesce("licence", "n.dir_licence").alias("licence"),
                "score",
                F.when(F.col("licence").isNotNull(), "own").when(F.col("n").isNotNull(), "inherited").alias("how"),
                F.col("n.dir").alias("source_dir"),
                F.coalesce("licence_file", F.lit(False)).alias("licence_file"),
            )
        )
        return scratch.keep(result, "licences")
