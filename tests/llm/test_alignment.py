from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import alignment as L
from tessera.llm.queries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = ["", None, " ", "  ", "a", " a", "a ", "  a  b ", "x▁y", "<s> </s> <0x41> <|endoftext|>", "\x00 a", "a\nb\n\n c \n", "é b  　 x", "don't can't  'tis"]
ODD += ["日本語のテキスト" * 30, "x" * 3000, "a b" * 500, " " * 900, "foo, bar's  baz\t\tqux " * 60, "<unk> 한국어 👩‍👩‍👧 z" * 20, "the cat sat. The cat\nsat", "the cat sat. The cat\nsat"]


def plain(rows):
    """Whole texts, one token after the other."""
    e = L.Encoders(A, B)
    groups, links, sizes = {}, {}, {}
    for k, (_, text) in enumerate(rows):
        groups[k], links[k], sizes[k] = [], [], (0, 0)
        full = (" " + (text or "")).encode()
        a, b = (e.a_ids([" " + text])[0], e.b_ids([text])[0]) if text else ([], [])
        if not text or b"".join(e.a_bytes[i] for i in a) != full or b"".join(e.b_bytes[i] for i in b) != full:
            continue
        sizes[k] = (len(a), len(b))
        i = j = at_a = at_b = 0
        left, right = [], []
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                left.append(a[i])
                at_a += len(e.a_bytes[a[i]])
                i += 1
            else:
                right.append(b[j])
                at_b += len(e.b_bytes[b[j]])
                j += 1
            if at_a == at_b:
                groups[k].append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
                links[k].append((left[-1], right[-1]))
                left, right = [], []
    count = Counter(x for v in links.values() for x in v)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return sorted(
        (str(doc), *sizes[k], len(groups[k]), len(groups[k]), sum(count[x] == best[x[1]] for x in links[k]), sum(count[x] for x in links[k]), hashlib.sha256(";".join(groups[k]).encode()).hexdigest() if groups[k] else "")
        for k, (doc, _) in enumerate(rows)
    )


def result(df, **options):
    return sorted((str(r[0]), *r[1:]) for r in L.token_alignment(df, A, B, **options).collect())


@pytest.mark.parametrize("chunk", [L.CHUNK, 300, 40, 5])
def test_odd_texts_in_ranges_of_any_size(spark, chunk):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(ODD)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), chunk=chunk) == plain(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = plain(rows)
    assert result(docs) == want and result(docs, chunk=2000) == want


def test_groups_as_text_and_extra_columns(spark, clashing):
    rows = [(1, "hello there, world " * 40), (2, None), (3, "x▁y")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    for chunk in (L.CHUNK, 60):
        got = {r.doc_id: r for r in L.token_alignment(df, A, B, chunk=chunk, with_groups=True).collect()}
        assert hashlib.sha256(got[1].groups.encode()).hexdigest() == got[1].groups_sha256
        assert (got[2].groups, got[3].groups, got[2].groups_sha256, got[3].n_a) == ("", "", "", 0)


def test_empty_table(spark):
    assert result(spark.createDataFrame([], "doc_id long, text string")) == []


def test_malformed_text_has_no_tokens(spark):
    df = spark.sql("SELECT 1L AS doc_id, cast(unhex('61ff62') AS string) AS text UNION ALL SELECT 2L, 'ok'")
    assert [r[1] for r in result(df)] == [0, plain([(2, "ok")])[0][1]]


def tokens(rng, total, size):
    ends, at = [], 0
    while at < total:
        at = min(total, at + rng.randint(1, size))
        ends.append(at)
    return L.Side(np.arange(len(ends)), np.array(ends))


def pieces(side, cuts):
    return [side.between(x, y) for x, y in zip([None, *cuts], [*cuts, None])]


def shown(x, closed):
    return [(s.ids.tolist(), s.ends.tolist()) for s in (*x.prefix, *x.suffix)], x.cut, sorted(g for c in closed for g in c)


@pytest.mark.parametrize("seed", range(25))
def test_composition_is_associative_and_gives_the_whole(seed):
    rng = random.Random(seed)
    total = rng.randint(1, 120)
    a, b = tokens(rng, total, rng.randint(1, 9)), tokens(rng, total, rng.randint(1, 9))
    cuts_a, cuts_b = (sorted(rng.choices([0, *s.ends.tolist()], k=5)) for s in (a, b))  # different places on either side
    leaves = [(x, [g.texts()]) for x, g in (L.fragment(*p) for p in zip(pieces(a, cuts_a), pieces(b, cuts_b)))]

    def joined(x, y):
        both, more = L.compose(x[0], y[0])
        return both, [*x[1], *y[1], more.texts()]

    def folded(parts):
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            parts = [*parts[:i], joined(parts[i], parts[i + 1]), *parts[i + 2 :]]
        return parts[0]

    whole, groups = L.fragment(a, b)
    want = shown(whole, [groups.texts()])
    for _ in range(6):
        assert shown(*folded(list(leaves))) == want


def test_new_words_are_encoded_together_with_the_ids_of_each_alone(monkeypatch):
    rng = random.Random(11)
    words = list(dict.fromkeys("".join(rng.choice("abcdeé.,'\n\t9") for _ in range(rng.randint(1, 12))) for _ in range(1500)))
    odd = ["", " x", "x ", "ﬁt", "½", "w" * 500, "İ", "<s>", "\x00"]  # spaces at an end, bytes that don't come back, a long one
    joint, alone = L.Encoders(A, B), L.Encoders(A, B)
    given = []
    plain_ids = joint.a_ids
    monkeypatch.setattr(joint, "a_ids", lambda texts: given.extend(texts) or plain_ids(texts))
    joint.learn(words)
    assert len(given) < len(words) / 50
    joint.learn(words + odd)
    monkeypatch.setattr(L.Encoders, "AT_ONCE_CHARS", 0)
    alone.learn(words + odd)
    assert not all(joint.same)
    for w in words + odd:
        x, y = joint.numbers([w]), alone.numbers([w])
        assert joint.same[x] == alone.same[y] and joint.texts[x[0]] == alone.texts[y[0]]
        assert all(joint.of(k, x).tolist() == alone.of(k, y).tolist() for k in ("a", "b", "link"))


def test_groups_of_small_and_large_ids_share_their_texts_of_numbers():
    one, ends = np.ones(1, dtype=np.int64), np.array([3])
    L._marks.cache_clear()
    for i in (0, 1, 5, 300, 40_000, 2, 65_535):
        assert L.aligned(one * i, ends, one, ends).text() == f"{i}|1"
    assert L._marks.cache_info().misses == 1
    assert L.aligned(one * 70_000, ends, one, ends).text() == "70000|1"
