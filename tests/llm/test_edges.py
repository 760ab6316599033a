"""Rows without a doc_id and repeated rows, in every operator and stage."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tessera.llm import decontaminate, exact_dedup, licenses, line_dedup, ngram_join, packing, quality_qda, secrets, suffix_dedup, url_filter
from tessera.llm.queries import tokenizer_path

LINE = "a line that is repeated and has more than forty characters in it"
TEXT = "password=abcdefgh12 and the quick brown fox jumps over the lazy dog and then some more words"
BASE = [(0, TEXT), (1, TEXT + " x"), (2, LINE), (3, None), (4, "x" * 900), (5, "y" * 300 + TEXT * 6)] + [(i, LINE + f"\n{i}") for i in range(6, 12)]
NAMELESS = [(None, TEXT), (None, None), (None, LINE)]


@pytest.fixture(scope="module")
def tables(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").coalesce(2)

    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog and then"), (None, "x"), (2, None)], "item_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(None, 1, None)], "doc_id long, quality int, toxic int")
    return make, items, labels


OPERATORS = {
    "op1": lambda d, items, labels: ngram_join.ngram_jaccard_join(d, 3, 80),
    "op3": lambda d, items, labels: exact_dedup.exact_duplicates(d),
    "op4": lambda d, items, labels: quality_qda.quality_scores(d, labels),
    "op5": lambda d, items, labels: secrets.scan_secrets(d),
    "op6": lambda d, items, labels: line_dedup.drop_repeated_lines(d).select("doc_id", "text", "n_lines", "n_dropped"),
    "op7": lambda d, items, labels: decontaminate.decontaminate(d, items),
    "op8": lambda d, items, labels: suffix_dedup.repeated_spans(d),
    "op9": lambda d, items, labels: licenses.scan_licences(d.selectExpr("cast(doc_id AS string) AS path", "text")),
    "op10": lambda d, items, labels: url_filter.judge_urls(d.selectExpr("doc_id AS page_id", "text AS url")),
}


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_without_an_id_get_a_row_and_change_no_other(tables, name):
    make, *rest = tables
    run = lambda rows: OPERATORS[name](make(rows), *rest)
    key = run(BASE).columns[0]
    plain, mixed = run(BASE), run(BASE + NAMELESS)
    assert mixed.count() == len(BASE) + len(NAMELESS) and mixed.where(f"{key} is null").count() == len(NAMELESS)
    if name not in ("op3", "op8", "op9"):  # these count every row's text
        assert rows_of(mixed.where(f"{key} is not null")) == rows_of(plain)


@pytest.mark.parametrize("name", OPERATORS)
def test_repeated_rows_get_the_same_row(tables, name):
    make, *rest = tables
    twice = OPERATORS[name](make(BASE + BASE), *rest)
    found = rows_of(twice)
    assert len(found) == 2 * len(BASE) and found[::2] == found[1::2]
    if name in ("op5", "op7", "op10"):  # of op9 the document frequencies change
        assert found[::2] == rows_of(OPERATORS[name](make(BASE), *rest))


def test_packing_takes_every_row(tables):
    make, *_ = tables
    rows = packing.pack_documents(make(BASE + BASE + NAMELESS), tokenizer_path()).collect()
    assert sum(r["start"] == 0 for r in rows) == 2 * len(BASE) + len(NAMELESS)


def test_stages_judge_rows_without_an_id_by_their_text(spark, tables, monkeypatch):
    """The classifier and decontamination treat them as rows of the same text
    with an id; the other stages keep them."""
    make, items, labels = tables
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, name: {"labels": labels, "benchmark": items}[name])
    docs = make(BASE + BASE + NAMELESS)
    twins = make(BASE + BASE + [(i, t) for i, (_, t) in enumerate(NAMELESS, 20)])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "unused")
        nameless = out.where("doc_id is null")
        if name in ("quality_classifier", "decontamination"):
            named = stage(spark, twins, "unused").where("doc_id >= 20")
            assert rows_of(nameless.select("text")) == rows_of(named.select("text")), name
            assert name != "decontamination" or nameless.count() == 2
        else:
            assert nameless.count() == len(NAMELESS), name
        empty = stage(spark, docs.where("false"), "unused")
        assert empty.count() == 0 and (name == "packing" or empty.columns == docs.columns), name
