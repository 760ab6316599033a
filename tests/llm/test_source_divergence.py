from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import re

from tessera.llm import source_divergence as S
from tessera.llm._text import chunks

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, min_docs=3, top=200):
    """Rows (lang, source, text) by the definition, in Python integers."""
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, docs, out = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        words = TERM.findall(text.translate(LOWER))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    for lang in {r[0] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = sorted({r[1] for r in rows if r[0] == lang})
        of_lang = Counter()
        for s in sources:
            of_lang.update(counts[lang, s])

        def p(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c[k] for k in kept) + len(kept))

        def ranked(source, part, values):
            for rank, (item, v) in enumerate(sorted(values, key=lambda x: (-x[1], x[0].encode())), 1):
                if part == "pair" or rank <= top:
                    out.add((lang, source, part, item, v, rank))

        for s in sources:
            c = counts[lang, s]
            ranked(s, "pair", [(o, sum((p(c, t) - p(counts[lang, o], t)) ** 2 // p(counts[lang, o], t) for t in kept)) for o in sources if o != s])
            ranked(s, "term", [(t, (p(c, t) - p(of_lang, t)) ** 2 // p(of_lang, t)) for t in kept if c[t] and p(c, t) > p(of_lang, t)])
    return out


def made(seed=5, rows=120):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i)}é" if i % 3 else f"W{chr(97 + i)}" for i in range(26)]
    out = [("en", "hot", "the the The wa wb")] * 40
    for _ in range(rows):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "hot", None, "z 9"])
        out.append((lang, source, " ".join(rng.choice(words) + rng.choice(["", "1", ".", "-x"]) for _ in range(rng.randint(0, 30)))))
    return out + [("en", "empty", None), ("xx", "only", "one two"), ("yy", "s", ""), ("yy", "t", "word")]


def result(spark, rows, **options):
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    return [tuple(r) for r in S.source_divergence(df, **options).collect()]


@pytest.mark.parametrize("block_bytes", [S.BLOCK_BYTES, 400])
def test_equals_the_definition_however_small_the_blocks(spark, block_bytes):
    rows = made()
    got = result(spark, rows, block_bytes=block_bytes, top_terms=7)
    assert len(got) == len(set(got)) and set(got) == plain(rows, top=7)


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    big = [(0, 1, 1), (999_999_999_999, 10**12, 7), (8 * 10**14, 8 * 10**15, 10**6)]
    df = spark.createDataFrame(big, "n long, total long, terms long")
    got = [r[0] for r in df.select(S.probability(F.col("n"), F.col("total"), F.col("terms"))).collect()]
    assert got == [1 + 10**9 * (n + 1) // (t + v) for n, t, v in big]


def test_empty_table_and_clashing_columns(spark, clashing):
    df = spark.createDataFrame(made(rows=30), "lang string, source string, text string")
    assert S.source_divergence(df.where("false")).count() == 0
    wide = clashing(df).withColumn("term", df.lang).withColumn("docs", df.source).withColumn("value", df.source)
    assert {tuple(r) for r in S.source_divergence(wide).collect()} == plain(made(rows=30))


def test_clashing_hashes_stay_apart_and_runs_merge_in_order():
    keys = np.array([5, 5, 9], dtype=np.uint64)
    part = S.Postings(keys, np.array([0, 0, 1], dtype=np.int32), pa.array(["x", "y", "x"]), np.array([1, 2, 3]), np.array([1, 1, 1]))
    both = S.combined([part, part])
    assert both.terms.to_pylist() == ["x", "y", "x"] and both.n.tolist() == [2, 4, 6] and both.docs.tolist() == [2, 2, 2]
    rng = np.random.default_rng(1)
    runs = []
    for _ in range(7):
        k = np.sort(rng.choice(500, size=rng.integers(1, 200), replace=False)).astype(np.uint64)
        runs.append(S.Postings(k, np.zeros(len(k), dtype=np.int32), pa.array([str(x) for x in k.tolist()]), np.ones(len(k), dtype=np.int64), np.ones(len(k), dtype=np.int64)))
    out = list(S.merged_runs(runs, rows=3))
    merged = np.concatenate([p.keys for p in out])
    want = Counter(x for r in runs for x in r.keys.tolist())
    assert merged.tolist() == sorted(want) and np.concatenate([p.n for p in out]).tolist() == [want[k] for k in sorted(want)]


def test_chunk_postings_count_documents_and_occurrences():
    texts = pa.array(["A a B", None, "a\x00b é", "É"])
    groups = S.Groups()
    number = groups.of([("l", "s"), ("l", "s"), ("l", "s"), ("l", "t")])
    (lo, hi, buf, offs), = chunks(texts)
    got = S.chunk_postings(buf, offs, number[lo:hi], groups.hashes)
    rows = {(t, groups.names[g], n, d) for t, g, n, d in zip(got.terms.to_pylist(), got.groups.tolist(), got.n.tolist(), got.docs.tolist())}
    assert rows == {("a", ("l", "s"), 3, 2), ("b", ("l", "s"), 2, 2), ("é", ("l", "s"), 1, 1), ("É", ("l", "t"), 1, 1)}
