"""The corpus pipeline's stages against plain Python, each on its own input."""

from __future__ import annotations

import corpus_pipeline as P
from tessera.llm.queries import table
from tessera.scratch import Scratch

from test_decontaminate import brute as contaminated
from test_line_dedup import brute as deduped
from test_ngram_join import brute as grouped

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    rows = {}
    with Scratch(spark) as scratch:
        for name, stage in P.STAGES[:-1]:
            docs = scratch.table(stage(spark, docs, SF_DIR), name)
            assert docs.columns == columns
            rows[name] = {r["doc_id"]: r for r in docs.collect()}
        last = P.STAGES[-1][1](spark, docs, SF_DIR).collect()
    first = {r["doc_id"]: r for r in table(spark, SF_DIR, "documents").collect()}
    quality = {r["doc_id"]: r["quality"] for r in table(spark, SF_DIR, "labels").collect()}
    kept = rows["quality_classifier"]
    assert all(kept[d] == first[d] for d in kept) and len(kept) < len(first)
    assert sum((d in kept) == (q == 1) for d, q in quality.items()) >= 0.95 * len(quality)

    ids = sorted(kept)
    lines = deduped([kept[d]["text"] for d in ids], 40, 5)
    assert {d: rows["line_dedup"][d]["text"] for d in ids} == {d: lines[i][0] for i, d in enumerate(ids)}
    assert all(r["n_chars"] == len(r["text"]) for r in rows["line_dedup"].values())

    groups = grouped([rows["line_dedup"][d]["text"] for d in ids], 5, 80)
    assert sorted(rows["ngram_join"]) == [d for i, d in enumerate(ids) if groups[i][1] == i]

    ids = sorted(rows["ngram_join"])
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    hits = contaminated([rows["ngram_join"][d]["text"] for d in ids], items, 10)
    assert sorted(rows["decontamination"]) == [d for i, d in enumerate(ids) if not hits[i][4]]

    sizes = {}
    for r in last:
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["length"]
        assert r["offset"] + r["length"] <= 4096
    assert sizes == {r["doc_id"]: r["doc_tokens"] for r in last} and sizes.keys() == rows["decontamination"].keys()
    whole = P.run(spark, SF_DIR)
    assert sorted(whole.drop("sequence_id", "offset").collect()) == sorted(tuple(r[c] for c in whole.drop("sequence_id", "offset").columns) for r in last)


def test_a_stage_is_dropped_when_the_next_is_written(spark, monkeypatch):
    seen, tables = [], Scratch.table

    def table_of(self, df, name="step"):
        seen.append(len(self._paths))
        return tables(self, df, name)

    same = lambda spark, docs, sf_dir: docs
    monkeypatch.setattr(P, "STAGES", [(f"same{i}", same) for i in range(5)])
    monkeypatch.setattr(Scratch, "table", table_of)
    assert P.run(spark, SF_DIR).count() == table(spark, SF_DIR, "documents").count()
    assert seen == [0, 1, 1, 1]
