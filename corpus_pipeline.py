"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; its output is written as Parquet in the shared checkpoint
folder and reread, and goes when the next stage's is written. All stages but the
last return the columns of ``documents``.

1. quality_classifier: documents predicted to be of label 0 go.
2. line_dedup: repeated lines go from ``text``; ``n_chars`` follows.
3. ngram_join: one document of each group of near copies stays (five-word
   shingles, Jaccard similarity of 0.8 or more).
4. decontamination: documents with a benchmark window go.
5. packing: pieces in sequences of at most 4096 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.decontaminate import keep_uncontaminated
from tessera.llm.line_dedup import drop_repeated_lines
from tessera.llm.ngram_join import keep_one_per_group
from tessera.llm.packing import pack_documents
from tessera.llm.quality_qda import keep_good
from tessera.llm.queries import table, tokenizer_path, workers_import
from tessera.scratch import Scratch


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    cleaned = drop_repeated_lines(docs)
    length = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length).select(docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return keep_one_per_group(docs, shingle_words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A classifier's fit and a tokenizer are not expressible in SQL; the stages are
#: tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    with Scratch(spark) as scratch:
        docs, before = table(spark, sf_dir, "documents"), None
        for name, stage in STAGES[:-1]:
            docs = scratch.table(stage(spark, docs, sf_dir), name)
            if before:
                scratch.drop(before)
            before = scratch.last
        name, stage = STAGES[-1]
        return scratch.keep(stage(spark, docs, sf_dir), name)


PIPELINE = {"pipeline": (run, ORACLE_SQL)}
