"""Packing: exact round trip, gapless sequences, little padding, best fit."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from conftest_llm import EDGE_TEXTS, near_copies
from tessera.llm._text import chunks
from tessera.llm.packing import END_ID, WordEncoder, best_fit_decreasing, pack, pack_documents
from tessera.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


TEXTS = [*EDGE_TEXTS, *near_copies(), "Don't stop... it's 12,5 (ok)!", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "İstanbul ΟΔΟΣ é Éx ﬁ ½ 中文字",
         "word " * 9000, "a,b;c.d: e. f! g?? .h 's 't", " nbsp em", "Ａ" * 5]


def test_words_encode_like_whole_texts(tokenizer):
    encoder = WordEncoder(tokenizer_path())
    got = [x.tolist() for _, _, buf, offs in chunks(pa.array(TEXTS, pa.string()), 300) for x in encoder.encode(buf, offs)]
    assert got == [e.ids for e in tokenizer.encode_batch([t or "" for t in TEXTS], add_special_tokens=False)]


@pytest.mark.parametrize("window", [64, 4096])
def test_round_trip(docs_of, clashing, tokenizer, window):
    rows = pack_documents(clashing(docs_of(TEXTS)).repartition(3), tokenizer_path(), window=window, with_ids=True).collect()
    want = {i: [*e.ids, END_ID] for i, e in enumerate(tokenizer.encode_batch([t or "" for t in TEXTS], add_special_tokens=False))}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        assert r["length"] == len(r["ids"]) > 0 and r["doc_tokens"] == len(want[r["doc_id"]])
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc, ids in want.items():
        pieces = sorted(by_doc[doc], key=lambda r: r["start"])
        assert [i for r in pieces for i in r["ids"]] == ids
        assert [r["start"] for r in pieces] == list(np.cumsum([0, *(r["length"] for r in pieces[:-1])]))
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == list(np.cumsum([0, *(r["length"] for r in pieces[:-1])]))
        assert sum(r["length"] for r in pieces) <= window


def test_empty_table(docs_of):
    assert pack_documents(docs_of(["a"]).where("false"), tokenizer_path()).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_takes_the_tightest_window(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 100) for _ in range(300)]
    rooms, where = [], []
    for i in sorted(range(300), key=lambda k: (-lengths[k], k)):
        fits = [r for r in rooms if r >= lengths[i]]
        if fits:
            rooms.remove(min(fits))
            where.append(min(fits) - lengths[i])
        else:
            where.append(100 - lengths[i])
        rooms.append(where[-1])
    got = best_fit_decreasing(lengths, 100)
    assert sorted(i for w in got for i in w) == list(range(300))
    assert sorted(100 - sum(lengths[i] for i in w) for w in got) == sorted(rooms)


@pytest.mark.parametrize("seed", range(5))
def test_little_padding(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([0, 1, 7, rng.randint(1, 900), rng.randint(1, 9000)]) for _ in range(rng.randint(1, 200))]
    used = [sum(p[2] for p in s) for s in pack(lengths)]
    assert sum(used) == sum(lengths) and all(0 < u <= 4096 for u in used)
    assert sum(4096 - u for u in used if u & (u - 1)) <= 0.016 * 4096 * len(used)
