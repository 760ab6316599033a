"""Exact dedup against plain Python, also with a filter that is far too small."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest

from conftest_llm import EDGE_TEXTS
from tessera.llm import exact_dedup as E
from tessera.scratch import Scratch


def brute(texts):
    plain = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    groups = defaultdict(list)
    for i, t in enumerate(plain):
        groups[t].append(i)
    return {i: (groups[t][0], len(groups[t]), groups[t][0] == i, hashlib.sha256(t.encode()).hexdigest()) for i, t in enumerate(plain)}


@pytest.mark.parametrize("bits", [1 << 29, 8])
def test_matches_plain_python(docs_of, clashing, monkeypatch, bits):
    monkeypatch.setattr(E, "filter_bits", lambda rows: min(bits, 1 << 16))
    rng = random.Random(bits)
    texts = [*EDGE_TEXTS, *(" \t\n".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(80)), "a\u00a0b", "a b", *["copy  of"] * 40, "é" * 4000, "é" * 4000]
    got = E.exact_duplicates(clashing(docs_of(texts)).repartition(3)).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got} == brute(texts)


def test_few_unique_texts_are_shuffled(spark, docs_of):
    docs = docs_of([f"text {i // 2 if i < 40 else i}" for i in range(2000)])
    from pyspark.sql import functions as F

    with Scratch(spark) as scratch:
        digests = docs.select("doc_id", F.unhex(F.sha2(E.normalised(F.col("text")), 256)).alias("digest"))
        maybe = {r["doc_id"] for r in E.possibly_repeated(digests, scratch).where("maybe").collect()}
    assert set(range(40)) <= maybe and len(maybe) < 40 + 2000 * 0.05


def test_empty_table(docs_of):
    assert E.exact_duplicates(docs_of(["a"]).where("false")).collect() == []
