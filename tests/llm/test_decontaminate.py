"""Decontamination against a plain search for every window."""

from __future__ import annotations

import random
import re

import pytest

from conftest_llm import EDGE_TEXTS
from tessera.llm import decontaminate as D


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(texts, items, window):
    out = {}
    for doc, text in enumerate(texts):
        w, hit, found = words(text), set(), set()
        for item, item_text in items:
            b = words(item_text)
            n = min(window, len(b))
            for s in range(len(b) - n + 1) if b else []:
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == b[s : s + n]:
                        hit |= set(range(at, at + n))
                        found.add(str(item))
        out[doc] = (len(w), len(hit), sorted(found), len(found), bool(hit))
    return out


ITEMS = [
    (1, "The quick brown Fox jumps over the lazy dog and then sleeps, again and again."),
    (2, "fünf Wörter stehen nur hier"),
    (3, None), (4, ""), (5, "..."), (6, "solo"), (7, "two words"),
    (10, "the quick brown fox jumps over the lazy dog and"),
    (11, "a a a a a a a a a a a a"),
]


@pytest.mark.parametrize("window,broadcast", [(10, 1 << 20), (4, 0)])
def test_matches_plain_search(spark, docs_of, clashing, monkeypatch, window, broadcast):
    monkeypatch.setattr(D, "BROADCAST_ROWS", broadcast)
    rng = random.Random(window)
    texts = [*EDGE_TEXTS, ITEMS[0][1] * 2, "x " + ITEMS[0][1].upper() + " y", "FÜNF fünf wörter stehen nur hier.", "fünf Wörter stehen nur", "Solo!", "two, words two", "a " * 30]
    pool = words(ITEMS[0][1]) + ["a", "two", "words", "solo", "zzz"]
    texts += [" ".join(pool[(k + rng.choice([0, 0, 0, 0, 1])) % len(pool)] for k in range(rng.randint(1, 40))) for _ in range(20)]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = D.decontaminate(clashing(docs_of(texts)), clashing(items), window).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["n_items"], r["contaminated"]) for r in rows}
    assert got == brute(texts, ITEMS, window)


def test_empty_tables_and_stage(spark, docs_of):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of(["solo here", None, "clean"])
    assert D.decontaminate(docs.where("false"), items).collect() == []
    assert [r["n_hit"] for r in D.decontaminate(docs, items.where("false")).collect()] == [0, 0, 0]
    kept = D.keep_uncontaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]



def test_items_and_documents_without_an_id(spark):
    items = spark.createDataFrame([(None, "one two three"), (None, "shared words"), (4, "shared words")], "item_id long, text string")
    rows = [(1, "x one two three"), (None, "one two three one"), (None, "clean"), (2, "shared words"), (None, None), (None, "one two three one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"], r["n_items"], r["contaminated"]) for r in D.decontaminate(docs, items).collect())
    nameless = ("None", 4, 3, [], 0, True)
    assert got == sorted([("1", 4, 3, [], 0, True), nameless, nameless, ("None", 1, 0, [], 0, False), ("None", 0, 0, [], 0, False), ("2", 2, 2, ["4"], 1, True)])
    assert sorted(str(r["text"]) for r in D.keep_uncontaminated(docs, items).collect()) == ["None", "clean"]
