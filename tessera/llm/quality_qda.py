"""Document quality by a regularised quadratic discriminant.

Each whole text becomes a vector of transformed statistics (:data:`FEATURES`).
Per class a mean and a shrunk covariance are fitted; a document's score is the
logistic of the difference of the two classes' log densities, each a
Mahalanobis distance through the inverse of a Cholesky factor that is computed
once, and of the class priors. All labelled rows take part in the fit: their
moments are summed where the rows are, and only the sums (a few hundred
numbers, whatever the row count) come back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._text import LOWER, SPACE, chunks, span_hash, words
from tessera.scratch import Scratch

FEATURES = (
    "log_words", "log_word_length", "upper", "digit", "plain_punctuation", "symbol", "exclamation",
    "symbol_ended_words", "distinct_words", "top_word", "repeated_neighbours", "log_line_words", "log_sentence_words",
)
#: Weight of the pooled covariance in each class's, and of the mean variance on
#: the diagonal (the shrinkage; chosen on training rows).
POOLED = 0.3
RIDGE = 0.15

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 0x41) & (_BYTE <= 0x5A)
_DIGIT = (_BYTE >= 0x30) & (_BYTE <= 0x39)
_PLAIN = np.isin(_BYTE, [ord(c) for c in ".,;:?'\"()-"])
_SYMBOL = (_BYTE > 0x20) & (_BYTE < 0x7F) & ~_UPPER & ~_DIGIT & ~_PLAIN & ~((_BYTE >= 0x61) & (_BYTE <= 0x7A))
_STOP = np.isin(_BYTE, [ord(c) for c in ".?!"])


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Log odds of a share, half a count on either side."""
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def features_of(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of :data:`FEATURES` per text of a chunk."""

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return np.diff(sums[offs]).astype(float)

    rows = len(offs) - 1
    starts, ends, first = words(buf, offs, ~SPACE)
    n = np.diff(first).astype(float)
    chars = count((buf & 0xC0) != 0x80)
    accented = np.zeros(len(buf), dtype=bool)  # capital letters with accents: 0xC3 0x80-0x9E
    if len(buf):
        accented[1:] = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E)
    letters = chars - count(SPACE[buf])

    def per_doc(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return np.diff(sums[first]).astype(float)

    hasher = span_hash(23)
    low = LOWER[buf]
    key = hasher.spans(hasher.prefix(low), starts, ends)
    owner = np.repeat(np.arange(rows), np.diff(first))
    same = np.zeros(len(key), dtype=bool)
    same[1:] = (key[1:] == key[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((key, owner))
    head = np.ones(len(key), dtype=bool)
    head[1:] = (key[order][1:] != key[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    heads = np.flatnonzero(head)
    runs = np.diff(np.append(heads, len(key)))
    top = np.zeros(rows)
    np.maximum.at(top, owner[order][heads], runs)
    distinct = np.bincount(owner[order][heads], minlength=rows).astype(float)
    ended = per_doc(_SYMBOL[buf[ends - 1]]) if len(ends) else np.zeros(rows)
    lines = count(buf == 0x0A) + 1
    return np.stack(
        (
            np.log1p(n),
            np.log1p(letters / np.maximum(n, 1)),
            _share(count(_UPPER[buf] | accented), letters),
            _share(count(_DIGIT[buf]), letters),
            _share(count(_PLAIN[buf]), letters),
            _share(count(_SYMBOL[buf]), letters),
            _share(count(buf == 0x21), letters),
            _share(ended, n),
            _share(distinct, n),
            _share(top, n),
            _share(per_doc(same), n),
            np.log1p(n / lines),
            np.log1p(n / (count(_STOP[buf]) + 1)),
        ),
        axis=1,
    )


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, buf, offs in chunks(batch.column(1)):
            x = features_of(buf, offs)
            flat = pa.array(x.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists], names=["doc_id", "x"])


def document_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the vector of every row; null texts count as empty."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _vectors, "doc_id long, x array<double>"
    )


@dataclass(frozen=True)
class QuadraticModel:
    """Per class (0, 1): mean, inverse Cholesky factor of the covariance, and
    log prior minus half its log determinant. Without a usable class pair
    ``means`` is None and every score is ``share``."""

    share: float
    means: tuple[np.ndarray, np.ndarray] | None = None
    factors: tuple[np.ndarray, np.ndarray] | None = None
    offsets: tuple[float, float] | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        parts = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.offsets)]
        return 1 / (1 + np.exp(-np.clip(parts[1] - parts[0], -500, 500)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        label = np.asarray(batch.column(0))
        x = np.asarray(batch.column(1).flatten()).reshape(-1, len(FEATURES))
        x = np.concatenate((np.ones((len(x), 1)), x), axis=1)
        for c in (0, 1):
            part = x[label == c]
            sums[c] = sums.get(c, 0) + (part.T @ part).ravel()
    for c, total in sums.items():
        at = pa.array(np.arange(len(total), dtype=np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), c, dtype=np.int32)), at, pa.array(total)], names=["label", "at", "value"])


def fit(features: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> QuadraticModel:
    """Fit on every row of ``labels`` (rows with a null or a label other than 0
    and 1 are left out; a document labelled twice counts twice)."""
    labelled = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    labelled = labelled.where("label in (0, 1)").join(features, "doc_id").select("label", "x")
    rows = labelled.mapInArrow(_moments, "label int, at int, value double").groupBy("label", "at").agg(F.sum("value").alias("value"))
    d = len(FEATURES) + 1
    moments = np.zeros((2, d * d))
    for r in rows.collect():  # 2 classes x 14 x 14 numbers
        moments[r["label"], r["at"]] = r["value"]
    moments = moments.reshape(2, d, d)
    n = moments[:, 0, 0]
    if n.min() < 2:
        return QuadraticModel(share=0.5 if not n.sum() else float(n[1] / n.sum()))
    means = moments[:, 0, 1:] / n[:, None]
    covs = moments[:, 1:, 1:] / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (covs * n[:, None, None]).sum(axis=0) / n.sum()
    factors, offsets = [], []
    for c in (0, 1):
        cov = (1 - POOLED) * covs[c] + POOLED * pooled
        cov = (1 - RIDGE) * cov + RIDGE * (np.trace(pooled) / len(pooled) + 1e-9) * np.eye(len(cov))
        chol = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(chol))
        offsets.append(float(np.log(n[c] / n.sum()) - np.log(np.diag(chol)).sum()))
    return QuadraticModel(float(n[1] / n.sum()), (means[0], means[1]), (factors[0], factors[1]), (offsets[0], offsets[1]))


def score(features: DataFrame, model: QuadraticModel) -> DataFrame:
    """(doc_id, score) of every row of ``features``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], names=["doc_id", "score"])

    return features.mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    """Rows no label is learnt from: crc32 of the id as text leaves 1 modulo 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1, higher:
    label 1 is likelier), predicted (1 from a score of 0.5).

    Null, empty and very long texts are scored like others. Without two labelled
    rows of each class every score is the share of label 1 (0.5 without labels).
    Repeated rows and rows without a doc_id are scored like others (the latter are
    not held out). Columns other than doc_id, text and quality are ignored. An
    empty table gives an empty result.
    """
    with Scratch(docs.sparkSession) as scratch:
        features = scratch.keep(document_features(docs), "features")
        model = fit(features, labels.where(~held_out(F.col("doc_id"))))
    return score(features, model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` but for those predicted to be of label 0, with or
    without a doc_id; all columns.

    Each text is scored where it is read, in the pass that filters, so no text is
    shuffled; the fit is that of :func:`quality_scores`.
    """
    with Scratch(docs.sparkSession) as scratch:
        features = scratch.table(document_features(docs), "features")
        model = fit(features, labels.where(~held_out(F.col("doc_id"))))

    @F.arrow_udf("boolean")
    def good(text: pa.Array) -> pa.Array:
        scores = [model.scores(features_of(buf, offs)) for _, _, buf, offs in chunks(text)]
        return pa.array(np.concatenate(scores) >= 0.5 if scores else [], pa.bool_())

    return docs.where(good(docs["text"]))
