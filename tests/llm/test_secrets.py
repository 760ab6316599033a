"""Secret scan: base spans against Python's re, model and ratios against plain sums."""

from __future__ import annotations

import random
import re
from math import log

import pytest
from pyspark.sql import functions as F

from conftest_llm import EDGE_TEXTS
from tessera.llm import secrets as S


def base(text):
    text, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(S.KINDS[k], a, b) for a, k, b in sorted(out)]


def texts():
    rng = random.Random(4)
    pieces = ["password", "Secret", "token", "api_key", "APIKEY", "passwd", "=", ":", " ", '"', "'", "é", "\n", "AKIA", "abcdefgh", "A1B2C3D4E5F6", "deadbeef" * 4, "0123456789abcdef", "-._/", "🙂", "ﬁ", "x" * 20]
    out = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(150)]
    return [*EDGE_TEXTS, *out, "secret: token: abcdefgh1", "ſecret=abcdefghij", "toKen=abcdefghij", "AKIA" + "A" * 11, "AKIA" + "A" * 12, "f" * 31, "f" * 32, "F" * 40]


def test_base_spans(docs_of, clashing):
    docs = texts()
    rows = S.scan_secrets(clashing(docs_of(docs))).collect()
    got = {r["doc_id"]: [tuple(s) for s in r["spans"] if s["kind"] != "markov"] for r in rows}
    want = {i: base(t) for i, t in enumerate(docs)}
    assert {i: (got[i], want[i], docs[i]) for i in want if got[i] != want[i]} == {}
    for r in rows:
        kinds = [s[0] for s in want[r["doc_id"]]]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [kinds.count(k) for k in S.KINDS[:3]]
        spans = [tuple(s) for s in r["spans"]]
        assert spans == sorted(spans, key=lambda s: (s[1], S.KINDS.index(s[0])))
        added = [s for s in spans if s[0] == "markov"]
        assert all(b[2] <= m[1] or b[1] >= m[2] for m in added for b in want[r["doc_id"]])


def test_markov_models(spark, docs_of):
    rng = random.Random(8)
    rand = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    word = lambda n: "".join(rng.choice(["the", "ing", "tion", "ent", "ra", "lo"]) for _ in range(n))
    docs = [f"token = {rand(40)} and {word(8)} {word(9)}_{word(6)}" for _ in range(60)]
    docs += [f"plain {rand(24)} here", f"plain {word(9)} here"]
    rows = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in S.scan_secrets(docs_of(docs)).collect()}
    assert rows[60] == [("markov", 6, 30)] and rows[61] == []
    tokens = spark.createDataFrame([(0, "ab0"), (3, "abcdefghijklmnopq"), (3, "abcdefghijklmnop0")], "kind int, value string").withColumn("clear", F.lit(True))
    ratios = S.train(tokens)
    n = len(S.ALPHABET)
    k = S.ALPHABET.index
    p = {("a", "b"): (1.5, 1 + 0.5 * n), ("b", "0"): (1.5, 1 + 0.5 * n), ("c", "d"): (0.5, 0.5 * n)}
    q = {("a", "b"): (1.5, 1 + 0.5 * n), ("b", "0"): (0.5, 1 + 0.5 * n), ("c", "d"): (1.5, 1 + 0.5 * n)}
    for a, b in p:
        assert ratios[k(a) * n + k(b)] == pytest.approx(log(p[a, b][0] / p[a, b][1]) - log(q[a, b][0] / q[a, b][1]))
    got = tokens.select("value", S.likelihood_ratio(F.col("value"), ratios).alias("r")).collect()
    assert {r["value"]: r["r"] for r in got} == pytest.approx({v: sum(ratios[k(a) * n + k(b)] for a, b in zip(v, v[1:])) for v in (r["value"] for r in got)})


def test_recall_and_precision_on_planted_secrets(docs_of):
    """Keys in forms that no fixed pattern knows are found; card numbers, words,
    names and dates beside them aren't."""
    rng = random.Random(21)
    draw = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    low, up, dig = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    parts = ["user", "name", "count", "total", "index", "page", "value", "get", "set", "order", "item", "table", "read", "write", "line"]
    secret = [draw(low + up + dig + "+/", 40) for _ in range(40)] + [draw(low + dig, 32) for _ in range(40)] + [draw(up + dig, 24) for _ in range(40)]
    plain = [draw(dig, 16) for _ in range(60)] + ["_".join(rng.choices(parts, k=4)) for _ in range(60)]
    plain += ["".join(w.title() for w in rng.choices(parts, k=5)) for _ in range(60)] + [rng.choice(parts).upper() * 4 for _ in range(20)]
    docs = [f"see {v} there" for v in secret + plain]
    found = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == "markov"] for r in S.scan_secrets(docs_of(docs)).collect()}
    hit = [i for i, spans in found.items() if spans]
    right = sum(i < len(secret) for i in hit)
    assert right / len(secret) >= 0.9 and right / len(hit) >= 0.95
    assert not any(found[i] for i in range(len(secret), len(secret) + 60))  # digits alone


def test_random_samples_are_fixed(spark):
    rows = S.random_samples(spark, 3).collect()
    assert len(rows) == 9 and all(len(r["value"]) >= 16 and set(r["value"]) <= set(S.ALPHABET) for r in rows)
    assert rows == S.random_samples(spark, 3).collect()


def test_no_samples_and_empty_table(docs_of):
    assert [r["spans"] for r in S.scan_secrets(docs_of(["0123456789abcdef0123", None])).collect()] == [[], []]
    assert S.scan_secrets(docs_of(["a"]).where("false")).collect() == []
