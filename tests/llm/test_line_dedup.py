"""Line dedup: rules against plain Python, and insert / delete against a rebuild."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from conftest_llm import EDGE_TEXTS
from tessera.llm import line_dedup as L
from tessera.scratch import Scratch

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(texts, min_chars, min_docs):
    holders = defaultdict(set)
    lines = [(t or "").split("\n") for t in texts]
    for i, part in enumerate(lines):
        for x in part:
            if len(key(x)) >= min_chars:
                holders[key(x)].add(i)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = {}
    for i, part in enumerate(lines):
        kept = [x for x in part if not (key(x) in gone and i < gone[key(x)])]
        out[i] = ("\n".join(kept), len(part), len(part) - len(kept))
    return out


def texts(seed, n):
    rng = random.Random(seed)
    pool = ["short", "", "   ", "É" * 11 + " x", "  Padded Line number one\t", "padded line NUMBER one", "çà et là, une ligne", "x" * 3000, "a\rb\x0b"]
    return [None, "", "\n", "\n\n", *("\n".join(rng.choice(pool) for _ in range(rng.randint(1, 7))) for _ in range(n)), *EDGE_TEXTS]


@pytest.mark.parametrize("min_chars,min_docs", [(10, 3), (1, 2), (40, 5)])
def test_matches_plain_python(docs_of, clashing, min_chars, min_docs):
    docs = texts(min_chars, 30)
    got = L.drop_repeated_lines(clashing(docs_of(docs)), min_chars, min_docs).collect()
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in got} == brute(docs, min_chars, min_docs)


def test_columns_and_empty_table(docs_of):
    docs = docs_of(["a"]).where("false")
    out = L.drop_repeated_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"] and out.collect() == []


def state(index):
    counts = sorted(map(tuple, index.counts.select("k1", "k2", "n_docs", "last_doc").collect()))
    return counts, sorted((r.k1, r.k2, r.doc_id, tuple(r.lines)) for r in index.refs.collect())


def test_insert_then_delete_is_a_rebuild(spark, docs_of):
    docs = docs_of(texts(5, 24))
    first, second = docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 3 = 0")
    with Scratch(spark) as scratch:
        part = L.with_filters(L.build_index(first, scratch, 5), scratch)
        whole = L.insert(part, second, scratch, 5)
        assert state(whole) == state(L.build_index(docs, scratch, 5))
        back = L.delete(whole, second, scratch)
        assert state(back) == state(part)
        keys = np.array([r["k2"] for r in back.counts.collect()])
        shard = np.mod(np.array([r["k1"] for r in back.counts.collect()]), back.shards)
        for r in back.filters.collect():
            inside = L.CuckooFilter(np.frombuffer(r["cells"], dtype=np.uint16))
            assert inside.contains(keys[shard == r["shard"]]).all()
            assert (inside.cells > 0).sum() == (shard == r["shard"]).sum()
        drops = lambda index: sorted((r["doc_id"], sorted(r["drop"])) for r in L.repeated_lines(index, scratch, 2).collect())
        assert drops(back) == drops(part)


def test_cuckoo_filter():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(-(2**63), 2**63 - 1, size=40_000))
    f = L.CuckooFilter.of(keys)
    assert f.contains(keys).all()
    others = rng.integers(-(2**63), 2**63 - 1, size=40_000)
    assert f.contains(others).mean() < 0.01
    f.delete(keys[:20_000])
    assert f.contains(keys[20_000:]).all() and f.contains(keys[:20_000]).mean() < 0.01
    assert L.CuckooFilter.of(np.zeros(0, dtype=np.int64)).contains(keys[:5]).sum() == 0


def test_too_large_filters_fall_back(spark, docs_of, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_BYTES", 0)
    docs = texts(9, 20)
    got = L.drop_repeated_lines(docs_of(docs), 5, 2).collect()
    assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in got} == brute(docs, 5, 2)
