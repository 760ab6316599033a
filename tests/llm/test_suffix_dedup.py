"""Repeated strings against a plain count of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from conftest_llm import EDGE_TEXTS
from tessera.llm import suffix_dedup as S


def brute(texts, depth):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + depth] for d in data for i in range(len(d) - depth + 1))
    out = {}
    for k, d in enumerate(data):
        gone = bytearray(len(d))
        for i in range(len(d) - depth + 1):
            if seen[d[i : i + depth]] > 1:
                gone[i : i + depth] = b"\1" * depth
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[k] = (len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed, depth):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 9)))
    text = lambda n: "".join(word() for _ in range(n))
    shared = [text(k * depth // 10) for k in (2, 3, 5, 9)]
    out = [*EDGE_TEXTS, "a" * (3 * depth), "ab" * depth, "a" * depth, text(depth), text(depth)]
    for _ in range(40):
        parts = [rng.choice([text(rng.randint(1, depth // 3)), rng.choice(shared)]) for _ in range(rng.randint(1, 5))]
        out.append("".join(parts))
    base = text(depth)
    for _ in range(25):
        at = rng.randrange(len(base))
        out.append(base[:at] + "XY" + base[at + 2 :])
    out += [out[20], out[20], out[25], shared[-1], shared[-1][1:], shared[-1][:-1]]
    return out


@pytest.mark.parametrize("depth,task_docs", [(64, 4096), (100, 3), (400, 4096)])
def test_matches_all_windows(docs_of, clashing, monkeypatch, depth, task_docs):
    monkeypatch.setattr(S, "TASK_DOCS", task_docs)
    texts = corpus(depth, depth)
    rows = S.repeated_spans(clashing(docs_of(texts)).repartition(3), depth).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    want = brute(texts, depth)
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}
    assert got == want


def test_the_query_says_which_documents_lose_bytes(spark):
    from tessera.llm.queries import op8_suffix_dedup

    rows = op8_suffix_dedup(spark, "/root/testdata/sf0.001").collect()
    assert {r["repeated"] for r in rows} == {True, False}
    assert all(r["repeated"] == (r["n_removed"] > 0) and r["n_kept"] == r["n_bytes"] - r["n_removed"] for r in rows)


def test_empty_table(docs_of):
    assert S.repeated_spans(docs_of(["a"]).where("false")).collect() == []


def test_pieces_of_long_texts(monkeypatch):
    rng = np.random.default_rng(0)
    buf = rng.integers(97, 100, size=5000).astype(np.uint8)
    offs = np.array([0, 10, 3000, 3000, 5000])
    whole = S.anchor_runs(buf, offs, 64)
    monkeypatch.setattr(S, "_PIECE", 700)
    cut = S.anchor_runs(buf, offs, 64)
    expand = lambda runs: [(r, int(g), s) for r, g, a, b in zip(*runs) for s in range(a, b + 1)]
    assert expand(whole) == expand(cut)
    assert [s for _, _, s in expand(whole)] == [*range(10, 3000 - 63), *range(3000, 5000 - 63)]
