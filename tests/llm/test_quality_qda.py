"""Quality scores: statistics against plain Python, the fit against NumPy, held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from conftest_llm import EDGE_TEXTS
from tessera.llm import quality_qda as Q
from tessera.llm._text import chunks
from tessera.llm.queries import op4_quality, table

SF_DIR = "/root/testdata/sf0.01"


def test_statistics():
    text = "Aa aa. BB\nÉé 12! x### aa"
    (x,) = [Q.features_of(buf, offs)[0] for _, _, buf, offs in chunks(pa.array([text]))]
    got = dict(zip(Q.FEATURES, x))
    words, letters = text.split(), len(text) - 6
    share = lambda a, n: np.log((a + 0.5) / (n - a + 0.5))
    want = {
        "log_words": np.log1p(len(words)), "log_word_length": np.log1p(letters / len(words)), "upper": share(4, letters), "digit": share(2, letters),
        "plain_punctuation": share(1, letters), "symbol": share(4, letters), "exclamation": share(1, letters), "symbol_ended_words": share(2, len(words)),
        "distinct_words": share(6, 7), "top_word": share(2, 7), "repeated_neighbours": share(0, 7), "log_line_words": np.log1p(7 / 2), "log_sentence_words": np.log1p(7 / 3),
    }
    assert got == pytest.approx(want)


def test_rows_do_not_depend_on_their_chunk():
    texts = [*EDGE_TEXTS, "Word word WORD word", "a a a b"]
    alone = np.concatenate([Q.features_of(b, o) for t in texts for _, _, b, o in chunks(pa.array([t], pa.string()))])
    together = np.concatenate([Q.features_of(b, o) for _, _, b, o in chunks(pa.array(texts, pa.string()))])
    np.testing.assert_allclose(alone, together)


def test_fit_matches_numpy(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    features = Q.document_features(docs)
    model = Q.fit(features, labels)
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = {r["doc_id"]: np.array(r["x"]) for r in features.collect()}
    x = {c: np.array([rows[d] for d, q in quality.items() if q == c]) for c in (0, 1)}
    for c in (0, 1):
        np.testing.assert_allclose(model.means[c], x[c].mean(axis=0), rtol=1e-6)
        cov = np.linalg.inv(model.factors[c].T @ model.factors[c])
        own = np.cov(x[c].T, bias=True)
        pooled = sum(np.cov(x[k].T, bias=True) * len(x[k]) for k in (0, 1)) / len(quality)
        want = (1 - Q.POOLED) * own + Q.POOLED * pooled
        want = (1 - Q.RIDGE) * want + Q.RIDGE * (np.trace(pooled) / len(pooled) + 1e-9) * np.eye(len(want))
        np.testing.assert_allclose(cov, want, rtol=1e-4, atol=1e-7)


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in op4_quality(spark, SF_DIR).collect()}
    assert len(rows) == table(spark, SF_DIR, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    labels = [(r["quality"], rows[r["doc_id"]]) for r in table(spark, SF_DIR, "labels").collect()]
    labels = [(q, r["predicted"]) for q, r in labels if r["held_out"]]
    assert len(labels) > 50 and np.mean([q == p for q, p in labels]) > 0.95


def test_edges(spark, docs_of, clashing):
    docs = clashing(docs_of(EDGE_TEXTS))
    label = lambda *rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    scores = lambda labels: {r["score"] for r in Q.quality_scores(docs, labels).collect()}
    assert scores(label((None, None, None))) == {0.5}
    assert scores(label(*((i, 1, 0) for i in range(9)), (9, None, 1))) == {1.0}
    both = label(*((i, i % 2, 0) for i in range(len(EDGE_TEXTS))))
    assert all(0 <= s <= 1 for s in scores(both)) and Q.quality_scores(docs, both).count() == len(EDGE_TEXTS)
    assert Q.quality_scores(docs.where("false"), both).collect() == []
    assert Q.keep_good(docs, both).columns == docs.columns


def test_filter_goes_by_the_scores(spark, clashing):
    labels = table(spark, SF_DIR, "labels")
    docs = clashing(table(spark, SF_DIR, "documents"))
    good = {r["doc_id"] for r in Q.quality_scores(docs, labels).where("predicted = 1").collect()}
    texts = sorted(str(r["text"]) for r in docs.where(docs["doc_id"].isin(list(good))).select("text").collect())
    nameless = docs.withColumn("doc_id", Q.F.when(Q.F.col("doc_id") % 2 == 0, Q.F.col("doc_id")))
    kept = Q.keep_good(docs, labels)
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == good and 0 < len(good) < docs.count()
    assert sorted(str(r["text"]) for r in kept.select("text").collect()) == texts
    some = labels.where("doc_id % 2 = 0")
    want = {str(r["text"]) for r in Q.keep_good(docs, some).select("text").collect()}
    assert {str(r["text"]) for r in Q.keep_good(nameless, some).select("text").collect()} == want
