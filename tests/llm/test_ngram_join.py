"""N-gram Jaccard join against all pairs in plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from conftest_llm import EDGE_TEXTS, near_copies
from tessera.llm import ngram_join
from tessera.llm.ngram_join import Threshold, keep_one_per_group, ngram_jaccard_join, part_signatures, tree_links


def shingles(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return set()
    return {tuple(words)} if len(words) < size else {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(texts, size, percent):
    sets = [shingles(t, size) for t in texts]
    links = [[] for _ in texts]
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                links[i].append(j)
                links[j].append(i)
    out = {}
    for i in range(len(texts)):
        seen, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()]:
                if k not in seen:
                    seen.add(k)
                    todo.append(k)
        out[i] = (len(sets[i]), min(seen), len(links[i]))
    return out


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in df.collect()}


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (1, 60)])
def test_matches_all_pairs(docs_of, clashing, size, percent):
    texts = near_copies() + EDGE_TEXTS
    got = result(ngram_jaccard_join(clashing(docs_of(texts)), size, percent))
    assert got == brute(texts, size, percent)


def test_blocks_of_a_large_family(docs_of, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 7)  # read on the driver, where blocks are dealt
    texts = near_copies(seed=3, groups=2, words=40) * 2 + near_copies(seed=5, groups=1)
    rng = random.Random(1)
    base = [f"v{i}" for i in range(50)]
    for _ in range(40):
        other = list(base)
        other[rng.randrange(50)] = rng.choice("abcdef")
        texts.append(" ".join(other))
    assert result(ngram_jaccard_join(docs_of(texts), 3, 80)) == brute(texts, 3, 80)


def test_empty_table_and_stage(spark, docs_of):
    none = docs_of(["x"]).where("false")
    assert ngram_jaccard_join(none).collect() == []
    docs = docs_of(["a b c d e f g", "a b c d e f g", None, "z"])
    kept = keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3]


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_screen_keeps_what_may_link(percent):
    limit = Threshold(percent)
    for n in [*range(1, 30), 100, 333]:
        for m in range(limit.least_partner(n), limit.largest_partner(n) + 1):
            both = limit.least_overlap(n + m)
            if both <= min(n, m):
                assert n - both <= limit.most_alone(n)


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    limit = Threshold(percent)
    for n in [*range(1, 40), 55, 100, 333, 1000]:
        for _ in range(12):
            whole = np.sort(rng.choice(2**62, size=2 * n + 2, replace=False).astype(np.uint64))
            a, rest = whole[rng.permutation(len(whole))][:n], None
            change = rng.integers(0, max(1, n // 8) + 1)
            rest = np.setdiff1d(whole, a)
            b = np.concatenate((a[change:], rest[: rng.integers(0, change + 2)]))
            a, b = np.sort(a), np.sort(b)
            both = len(np.intersect1d(a, b))
            if len(b) and both >= limit.least_overlap(len(a) + len(b)):
                assert np.intersect1d(part_signatures(a, percent), part_signatures(b, percent)).size


@pytest.mark.parametrize("bits", [64, 1 << 14])
def test_tree_finds_every_link(monkeypatch, bits):
    monkeypatch.setattr(ngram_join, "MAX_BITS", bits)
    rng = np.random.default_rng(2)
    pool = rng.choice(2**62, size=300, replace=False).astype(np.uint64)
    sets = [np.sort(rng.choice(pool[:130], size=rng.integers(90, 130), replace=False)) for _ in range(60)]
    sets += [np.sort(rng.choice(pool, size=rng.integers(1, 9), replace=False)) for _ in range(30)]
    limit = Threshold(80)
    want = {(i, j) for j in range(len(sets)) for i in range(j) if len(np.intersect1d(sets[i], sets[j])) >= limit.least_overlap(len(sets[i]) + len(sets[j]))}
    got = [tuple(sorted(p)) for i, j in tree_links(sets, None, limit) for p in zip(i.tolist(), j.tolist())]
    assert len(got) == len(set(got)) and set(got) == want
    side = np.arange(len(sets)) % 2
    across = {tuple(sorted(p)) for i, j in tree_links(sets, side, limit) for p in zip(i.tolist(), j.tolist())}
    assert across == {(i, j) for i, j in want if side[i] != side[j]}


@pytest.mark.parametrize("ids", [lambda i: -1 - i, lambda i: 64 * 6 * i, lambda i: i - 20, lambda i: -(2**62) + 211 * i])
def test_links_do_not_depend_on_the_ids(spark, ids):
    texts = near_copies(seed=11)
    schema = "doc_id long, text string"
    groups = lambda df: sorted(sorted(r.doc_id for r in rows) for rows in grouped(df).values())

    def grouped(df):
        out = {}
        for r in ngram_jaccard_join(df, shingle_words=3, percent=80).collect():
            out.setdefault(r.component_id, []).append(r)
        return out

    plain = groups(spark.createDataFrame(list(enumerate(texts)), schema))
    spread = spark.createDataFrame([(ids(i), t) for i, t in enumerate(texts)], schema).repartition(len(texts))  # one document to a task
    back = {ids(i): i for i in range(len(texts))}
    assert sorted(sorted(back[x] for x in g) for g in groups(spread)) == plain and any(len(g) > 1 for g in plain)


def test_texts_with_one_passage_are_no_large_family(spark, docs_of, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 8)
    sent, join_blocks = spark.sparkContext.accumulator(0), ngram_join._join_blocks

    def counted(percent):
        solve = join_blocks(percent)

        def run(batches):
            def seen():
                for batch in batches:
                    sent.add(batch.num_rows)
                    yield batch

            return solve(seen())

        return run

    monkeypatch.setattr(ngram_join, "_join_blocks", counted)
    rng = random.Random(4)
    passage, texts = [f"p{i}" for i in range(40)], []
    for g in range(50):  # pairs of near copies that share the passage with all others
        own = [f"g{g}w{i}" for i in range(40)]
        texts += [" ".join(passage + own), " ".join(passage + own[:-1] + [f"g{g}end"])]
    texts += [" ".join(passage)] * 3 + [" ".join(passage[: rng.randint(34, 40)]) for _ in range(4)]
    got = docs_of(texts)
    got = got.unionByName(got.where("doc_id in (3, 8)"))  # repeated rows
    want = brute(texts + [texts[3], texts[8]], 3, 80)
    rows = [(r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_jaccard_join(got, 3, 80).orderBy("doc_id").collect()]
    twice = sorted([*range(len(texts)), 3, 8])
    assert rows == [want[i] for i in twice]
    assert sent.value < 2 * len(texts)
    # the same without the cut, where every set goes to each block of one family
    monkeypatch.setattr(ngram_join, "_cut_families", lambda members, *_: members)
    before, plain = sent.value, ngram_jaccard_join(got, 3, 80).orderBy("doc_id").collect()
    assert [(r["n_shingles"], r["component_id"], r["n_links"]) for r in plain] == rows
    assert sent.value - before > 5 * len(texts)
