"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each text gives ``len(FEATURES)`` statistics of its whole bytes (lengths, shares of kinds of characters, repetition),
transformed towards normality. Class means and covariances come from sums that Spark adds up over every training row.
A class covariance is shrunk towards the pooled one (``SHRINK``) and towards its own mean variance (``RIDGE``); the model
keeps the Cholesky factors, and the score is the logistic of the difference of the two log densities plus log prior odds.

Null and empty texts have the statistics of an empty text and get a score. Labels other than 0 and 1 (or null) are not
learned from; several labels of a document count each. Repeated documents each get a row; extra columns are ignored.
With one class missing, every score is the share of the other (0.5 with no labels at all).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swelter.llm.common import BLANK_WORDS, Words, durable, slices, small_batches, text_buffer

FEATURES = ("length", "words", "word_length", "upper", "digit", "mark", "sentence_mark", "line", "non_ascii", "distinct", "marked_word", "repeated_pair")
SHRINK, RIDGE, THRESHOLD = 0.3, 0.05, 0.3

_KINDS = {"upper": range(0x41, 0x5B), "digit": range(0x30, 0x3A), "mark": [x for x in [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)] if chr(x) not in ".,;:?'\"-()"], "sentence_mark": list(b".,;:?!"), "line": [0x0A], "non_ascii": range(0x80, 0x100)}
_TABLES = {}
for _name, _bytes in _KINDS.items():
    _TABLES[_name] = np.zeros(256, np.int64)
    _TABLES[_name][list(_bytes)] = 1


def _sums(x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(x)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _distinct(x: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct values of each row."""
    key = np.sort((x >> np.uint64(24)) | (row.astype(np.uint64) << np.uint64(40)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of transformed statistics for each text."""
    out = [np.zeros((0, len(FEATURES)))]
    for i, j in slices(offsets):
        d, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        w = Words(d, o, BLANK_WORDS)
        size, words = np.maximum(np.diff(o), 1.0), np.maximum(w.counts, 1.0)
        row = np.repeat(np.arange(j - i), w.counts)
        pairs = w.grams(2)
        real = w.left() >= 2
        share = {k: _sums(t[d], o) / size for k, t in _TABLES.items()}
        marks = np.concatenate([[0], np.cumsum(_TABLES["mark"][d])])
        f = {
            "length": np.log1p(np.diff(o)),
            "words": np.log1p(w.counts),
            "word_length": np.log1p(_sums((w.ends - w.starts).astype(np.int64), w.first) / words),
            "distinct": _distinct(w.hashes, row, j - i) / words,
            "marked_word": _sums((marks[w.ends] > marks[w.starts]).astype(np.int64), w.first) / words,
            "repeated_pair": 1 - _distinct(pairs[real], row[real], j - i) / np.maximum(w.counts - 1, 1.0),
        } | share
        for k in (*share, "distinct", "marked_word", "repeated_pair"):
            f[k] = np.arcsin(np.sqrt(np.clip(f[k], 0, 1)))
        out.append(np.stack([f[k] for k in FEATURES], 1))
    return np.concatenate(out)


def _forward(factor: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The solution of factor @ z = b for a lower triangular factor, by forward substitution."""
    z = np.empty_like(b)
    for k in range(len(factor)):
        z[k] = (b[k] - factor[k, :k] @ z[:k]) / factor[k, k]
    return z


@dataclass
class Discriminant:
    """Means, Cholesky factors and log determinants of both classes, and the log prior odds of class 1."""

    means: np.ndarray
    factors: np.ndarray
    logdets: np.ndarray
    odds: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.means):
            return np.full(len(x), 1 / (1 + np.exp(-self.odds)))
        log = []
        for mean, factor, logdet in zip(self.means, self.factors, self.logdets, strict=True):
            z = _forward(factor, (x - mean).T)
            log.append(-0.5 * (z * z).sum(0) - 0.5 * logdet)
        return 1 / (1 + np.exp(-np.clip(log[1] - log[0] + self.odds, -500, 500)))


def discriminant(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray, shrink: float = SHRINK, ridge: float = RIDGE) -> Discriminant:
    """The model from each class's row count, sums and sums of products."""
    odds = float(np.log((counts[1] + 0.5) / (counts[0] + 0.5)))
    if counts.min() < 2:
        return Discriminant(*np.zeros((3, 0)), odds if counts.sum() else 0.0)
    means = sums / counts[:, None]
    scatter = squares - counts[:, None, None] * np.einsum("ci,cj->cij", means, means)
    pooled = scatter.sum(0) / counts.sum()
    cov = (1 - shrink) * scatter / counts[:, None, None] + shrink * pooled
    p = cov.shape[1]
    level = np.trace(cov, axis1=1, axis2=2) / p
    cov = (1 - ridge) * cov + (ridge * level + 1e-9)[:, None, None] * np.eye(p)
    factors = np.linalg.cholesky(cov)
    return Discriminant(means, factors, 2 * np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(1), odds)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def featurize(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics of the text, for every document."""

    def run(batches):
        for b in batches:
            x = statistics(*text_buffer(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))], ["doc_id", "x"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, x array<double>")


def fit(features: DataFrame, labels: DataFrame, *, label: str = "quality", shrink: float = SHRINK, ridge: float = RIDGE) -> Discriminant:
    """Learn from the labelled documents of the training folds; only sums leave the executors."""
    known = labels.where(F.col(label).isin(0, 1) & (fold(F.col("doc_id")) != 0)).select("doc_id", F.col(label).cast("int").alias("y"))
    size = len(FEATURES)

    def partial(batches):
        n, total = np.zeros(2), np.zeros((2, size + size * size))
        for b in batches:
            y, x = b.column(0).to_numpy(), b.column(1).flatten().to_numpy().reshape(-1, size)
            for c in (0, 1):
                own = x[y == c]
                n[c] += len(own)
                total[c] += np.concatenate([own.sum(0), (own.T @ own).ravel()])
        rows = [(c, k, v) for c in (0, 1) for k, v in enumerate([n[c], *total[c]])]
        yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*rows, strict=True)], ["c", "k", "v"])

    parts = features.join(known, "doc_id").select("y", "x").mapInArrow(partial, "c long, k long, v double")
    got = np.zeros((2, 1 + size + size * size))
    for c, k, v in parts.groupBy("c", "k").agg(F.sum("v")).collect():  # two rows for each entry of a small matrix
        got[c, k] = v
    return discriminant(got[:, 0], got[:, 1 : 1 + size], got[:, 1 + size :].reshape(2, size, size), shrink, ridge)


def score(docs: DataFrame, model: Discriminant) -> DataFrame:
    """The documents with their ``score``; only the text goes to Python and only the score comes back."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(text: pa.Array) -> pa.Array:
        return pa.array(sent.value.scores(statistics(*text_buffer(text))))

    return small_batches(docs).withColumn("score", scored("text"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; its statistics are taken once."""
    features = durable(featurize(docs))
    sent = docs.sparkSession.sparkContext.broadcast(fit(features, labels))

    def run(batches):
        for b in batches:
            s = sent.value.scores(b.column(1).flatten().to_numpy().reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    out = features.mapInArrow(run, "doc_id long, score double, predicted int")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
