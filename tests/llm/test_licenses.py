"""Licence scan against plain TF-IDF and a plain walk up the directories."""

from __future__ import annotations

import re
import textwrap
from math import log, sqrt

import pytest

from tessera.llm.licenses import COSINE, FILE_SHARE, FULL_TEXTS, HEADERS, OPENING_WORDS, OPENINGS, _prefix, scan_licences

MIT, APACHE, ALL = HEADERS[0][1], HEADERS[3][1], HEADERS[-1][1]
NOTICE = HEADERS[7][1]
FULL = {name: " ".join(text.split()) for name, text in FULL_TEXTS}
WORDS = "some code that does things with numbers and prints them out in a loop until it is done then returns"


def wrapped(text, width, mark=""):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


FILES = [
    ("LICENSE", MIT), ("a.py", "code here"), ("src/b.py", f"# {APACHE}\ncode"), ("src/c.py", "some code the license is"), ("src/d/COPYING", f"{ALL}\n{ALL}"), ("src/d/x/y/e.py", None),
    ("src/d/f.py", f"x {ALL.upper()}\r\n{MIT}"), ("src/d2/g.py", ""), ("src/d/LICENCE", f"{APACHE}"), ("other/h.py", "licensed under nothing at all, all rights"), ("other/LICENSE", "released under the mit license"),
    ("other/i/j", "the the the"), ("src/d/k.py", "word " * 3000 + "\n" + ALL + "\n" + "word " * 3000), ("é/ü.py", "mit"), ("src/l.py", "all rights reserved all rights reserved"),
    ("mit/LICENSE", "Copyright (c) 2020 Some Body\n\n" + wrapped(FULL["MIT"], 70)), ("mit/a/b.py", WORDS), ("bsd/COPYING", wrapped(FULL["BSD-3-Clause"].upper(), 50)), ("bsd/x", WORDS),
    ("isc/LICENSE.txt", "ISC License\n" + wrapped(FULL["ISC"], 60)), ("isc/y/z", WORDS), ("half/LICENSE", wrapped(FULL["MIT"][:420], 70)),
    ("apache/LICENSE", wrapped(OPENINGS[0][1], 30) + "\n" + wrapped(WORDS * 90, 70)), ("apache/m.py", WORDS), ("gpl/COPYING", wrapped(OPENINGS[1][1], 25) + "\n" + wrapped(WORDS * 300, 70)), ("gpl/n.py", WORDS),
    ("gpl2/late.txt", WORDS * 20 + OPENINGS[2][1]), ("gpl2/o.py", WORDS), ("head/p.py", wrapped(NOTICE, 60, " * ") + "\n" + wrapped(WORDS * 9, 70)), ("head/q.py", "prefix words " + wrapped(HEADERS[1][1], 33, "// ") + " " + WORDS * 5),
    ("spdx/r.py", "# SPDX-License-Identifier: Apache-2.0\n" + WORDS), ("spdx/s.py", "/* SPDX-License-Identifier: MIT */ " + ALL), ("spdx/t.py", "SPDX-License-Identifier: (GPL-2.0+ OR MIT)"), ("spdx/u.py", "SPDX-License-Identifier:"),
]


def tok(text):
    return re.findall(r"[a-z0-9]+", (text or "").lower())


def brute(files):
    """Every window of every text, and every whole text."""
    found = [("header", *x) for x in HEADERS] + [("opening", *x) for x in OPENINGS] + [("full", *x) for x in FULL_TEXTS]
    vocabulary = {w for _, _, t in found for w in tok(t)}
    n = len(files)
    idf = {w: log((n + 1) / (sum(w in tok(t) for _, t in files) + 1)) + 1 for w in vocabulary}
    weight = lambda words: {w: words.count(w) * idf.get(w, log(n + 1) + 1) for w in set(words)}
    norm = lambda v: sqrt(sum(x * x for x in v.values()))
    own, licence_file = {}, {}
    for path, text in files:
        words, hits, inside, whole = tok(text), [], set(), False
        for k, (kind, name, template) in enumerate(found):
            t = weight(tok(template))
            prefix = set(_prefix({w: x / norm(t) for w, x in t.items()}, COSINE))
            size = len(tok(template))
            anchors = {i - j for i, w in enumerate(words) if w in prefix for j, x in enumerate(tok(template)) if x == w}
            for first in [0] if kind == "full" else sorted({max(0, a) for a in anchors}):
                v = weight(words if kind == "full" else words[first : first + size])
                score = round(sum(v.get(w, 0) * x for w, x in t.items()) / norm(v) / norm(t), 9) if v else 0
                if score >= COSINE:
                    hits.append((score, -first, -k, name))
                    whole |= kind == "full" or (kind == "opening" and first <= OPENING_WORDS)
                    if kind != "full":
                        inside |= set(range(first, first + size))
        spdx = re.search(r"(?i)SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]*[A-Za-z0-9+])", text or "")
        if hits or spdx:
            own[path] = (spdx[1], 1.0) if spdx else (max(hits)[3], max(hits)[0])
            licence_file[path] = bool(hits) and (whole or len(inside) >= FILE_SHARE * len(words))
    dirs = {}
    for path in sorted(p for p, x in licence_file.items() if x):
        d = path.rpartition("/")[0]
        if d not in dirs or own[path][1] > dirs[d][1]:
            dirs[d] = own[path]
    out = {}
    for path, _ in files:
        if path in own:
            out[path] = (*own[path], "own", None, licence_file[path])
            continue
        d, out[path] = path, (None, None, None, None, False)
        while d:
            d = d.rpartition("/")[0]
            if d in dirs:
                out[path] = (dirs[d][0], None, "inherited", d, False)
                break
    return out


@pytest.fixture(scope="module")
def scanned(spark):
    return {r["path"]: r for r in scan_licences(spark.createDataFrame(FILES, "path string, text string").repartition(3)).collect()}


def test_matches_plain_python(scanned):
    want = brute(FILES)
    assert scanned.keys() == want.keys()
    for path, w in want.items():
        r = scanned[path]
        assert (r["licence"], r["how"], r["source_dir"], r["licence_file"]) == (w[0], *w[2:]), path
        assert r["score"] == (None if w[1] is None else pytest.approx(w[1], abs=1e-6)), path
    assert {w[2] for w in want.values()} == {"own", "inherited"}  # the root has a licence file


@pytest.mark.parametrize("folder,licence,below", [("mit/LICENSE", "MIT", "mit/a/b.py"), ("bsd/COPYING", "BSD-3-Clause", "bsd/x"), ("isc/LICENSE.txt", "ISC", "isc/y/z"), ("apache/LICENSE", "Apache-2.0", "apache/m.py"), ("gpl/COPYING", "GPL-3.0", "gpl/n.py")])
def test_full_texts_license_their_folder(scanned, folder, licence, below):
    assert scanned[folder]["licence_file"] and scanned[folder]["licence"] == licence
    assert (scanned[below]["licence"], scanned[below]["how"], scanned[below]["source_dir"]) == (licence, "inherited", folder.partition("/")[0])


def test_wrapped_headers_and_identifiers(scanned):
    assert [scanned[f"head/{p}.py"]["licence"] for p in "pq"] == ["GPL-3.0", "MIT"] and not scanned["head/p.py"]["licence_file"]
    assert [scanned[f"spdx/{p}.py"]["licence"] for p in "rstu"] == ["Apache-2.0", "MIT", "GPL-2.0+", "MIT"] and scanned["spdx/u.py"]["how"] == "inherited"
    assert scanned["gpl2/late.txt"]["licence"] == "GPL-2.0" and not scanned["gpl2/late.txt"]["licence_file"]


def test_clashing_columns_repeated_rows_and_null_paths(spark, clashing):
    some = FILES[:6] + FILES[15:17]
    plain = {r["path"]: tuple(r) for r in scan_licences(spark.createDataFrame(some, "path string, text string")).collect()}
    files = clashing(spark.createDataFrame(some, "path string, text string"))
    assert {r["path"]: tuple(r) for r in scan_licences(files).collect()} == plain
    twice = scan_licences(files.unionByName(files.where("path = 'a.py'")).unionByName(files.limit(1).selectExpr("cast(null AS string) AS path", "* except (path)"))).collect()
    assert len(twice) == len(some) + 2 and [r["licence"] for r in twice if r["path"] is None] == [None]


def test_empty_tables(spark):
    files = spark.createDataFrame(FILES[:4], "path string, text string")
    assert scan_licences(files.where("false")).collect() == []
    assert {r["how"] for r in scan_licences(files, headers=(), openings=(), full_texts=()).collect()} == {None}
