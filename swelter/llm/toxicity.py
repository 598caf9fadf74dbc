"""Toxicity by cumulative-link ordinal regression on sparse text features.

A model of grades 0 < 1 < ... < G-1 with one weight per feature, shared by all thresholds: P(grade <= k) =
logistic(threshold_k - w.x). Features are one plus the log counts of the ``FEATURES`` word hashes that tell the lowest grade from the others
best (by the z-score of their log odds, ``MIN_Z`` at least). It learns from a hash-ordered sample of at most ``SAMPLE`` labelled documents, the one
bound here; scoring covers every word of every document. The expected grade is the severity.

Labels of one bit are graded here: 0 clean, 1 toxic, 2 toxic with more telling words than the median.

Null and empty texts score what the thresholds alone say. Labels that are null are not learned from; of several labels of a
document the highest counts, and of several rows of a labelled document the one whose text has the smallest hash. With no toxic or
no clean label, every severity is 0. Repeated documents each get their row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swelter.llm.common import PLAIN_WORDS, Words, in_sorted, slices, small_batches, text_buffer
from swelter.llm.quality import fold

SAMPLE, FEATURES, MIN_DOCS, MIN_Z, TELLING_Z, CUT = 20_000, 4096, 3, 2.5, 3.5, 0.3


@dataclass
class Ordinal:
    """Sorted word hashes, their weights, and increasing thresholds."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, z: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, a column per threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None] - z[:, None], -500, 500)))


def logits(data: np.ndarray, offsets: np.ndarray, model: Ordinal) -> np.ndarray:
    out = [np.zeros(0)]
    for i, j in slices(offsets):
        w = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], PLAIN_WORDS)
        at = in_sorted(w.hashes, model.words)
        row = np.repeat(np.arange(j - i), w.counts)
        pair, n = np.unique(row[at >= 0] * len(model.words) + at[at >= 0], return_counts=True)
        out.append(np.bincount(pair // max(len(model.words), 1), (1 + np.log(n)) * model.weights[pair % max(len(model.words), 1)], minlength=j - i) if len(pair) else np.zeros(j - i))
    return np.concatenate(out)


def ordinal(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, n_features: int, *, ridge: float = 1e-5, steps: int = 400, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the penalised likelihood (full-batch Adam; thresholds kept ordered by their gaps)."""
    top = int(grades.max())
    share = np.array([(grades <= k).mean() for k in range(top)]).clip(1e-4, 1 - 1e-4)
    start = np.log(share / (1 - share))
    p = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    m, v, n = np.zeros_like(p), np.zeros_like(p), len(grades)
    for t in range(1, steps + 1):
        w, gaps = p[:n_features], np.exp(p[n_features + 1 :])
        theta = p[n_features] + np.concatenate([[0], np.cumsum(gaps)])
        z = np.bincount(rows, values * w[cols], minlength=n)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        low, high = (1 / (1 + np.exp(-np.clip(edge[grades + k] - z, -500, 500))) for k in (0, 1))
        like = np.maximum(high - low, 1e-12)
        d_low, d_high = low * (1 - low), high * (1 - high)
        d_z = (d_high - d_low) / like / n  # of the negative log likelihood
        d_theta = np.array([-(d_high[grades == k] / like[grades == k]).sum() + (d_low[grades == k + 1] / like[grades == k + 1]).sum() for k in range(top)]) / n
        g = np.concatenate([np.bincount(cols, values * d_z[rows], minlength=n_features) + ridge * w, [d_theta.sum()], gaps * np.cumsum(d_theta[::-1])[::-1][1:]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return p[:n_features], p[n_features] + np.concatenate([[0], np.cumsum(np.exp(p[n_features + 1 :]))])


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", sample: int = SAMPLE, features: int = FEATURES) -> Ordinal:
    """Learn from labelled documents outside the held-out fold."""
    spark = docs.sparkSession
    known = labels.where(F.col(label).isin(0, 1) & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def words(batches):
        for b in batches:
            data, offsets = text_buffer(b.column(1))
            for i, j in slices(offsets):
                w = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], PLAIN_WORDS)
                for r in range(i, j):
                    h, n = np.unique(w.hashes[w.first[r - i] : w.first[r - i + 1]], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[r].as_py()], pa.int32()), pa.array([int(w.counts[r - i])], pa.int64()), pa.array([h.view(np.int64)], pa.list_(pa.int64())), pa.array([n.astype(np.int32)], pa.list_(pa.int32()))], ["y", "size", "h", "n"])

    # the sample has a fixed bound, so its ids can be broadcast; rows of one id are reduced to one before they are shuffled
    rows = small_batches(docs).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    single = rows.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one"))
    bags = single.select("y", "one.text").mapInArrow(words, "y int, size long, h array<long>, n array<int>").persist()
    total = {r["y"]: r["d"] for r in bags.groupBy("y").agg(F.count("*").alias("d")).collect()}
    if not total.get(0) or not total.get(1):
        bags.unpersist()
        return Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.array([500.0]))
    counted = bags.select("y", F.explode("h").alias("h")).groupBy("h").agg(*(F.count(F.when(F.col("y") == y, 1)).alias(f"d{y}") for y in (0, 1))).where(F.col("d0") + F.col("d1") >= MIN_DOCS)
    a, b = F.col("d1") + 0.5, F.col("d0") + 0.5
    ratio = F.log(a / (total[1] - F.col("d1") + 0.5)) - F.log(b / (total[0] - F.col("d0") + 0.5))
    ranked = counted.withColumn("z", ratio / F.sqrt(1 / a + 1 / b)).where(F.abs("z") >= MIN_Z).orderBy(F.desc(F.abs("z")), "h").limit(features).collect()  # so many features
    table = np.array([r["h"] for r in ranked], np.int64).view(np.uint64)
    telling = np.sort(table[np.array([r["z"] > TELLING_Z for r in ranked], bool)])
    table = np.sort(table)
    sent = spark.sparkContext.broadcast((table, telling))

    def narrow(batches):
        table, telling = sent.value
        for b in batches:
            for y, size, h, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                h, n = np.array(h, np.int64).view(np.uint64), np.array(n)
                at = in_sorted(h, table)
                share = float(n[in_sorted(h, telling) >= 0].sum())
                yield pa.RecordBatch.from_arrays([pa.array([y], pa.int32()), pa.array([share], pa.float64()), pa.array([at[at >= 0].tolist()], pa.list_(pa.int32())), pa.array([n[at >= 0].tolist()], pa.list_(pa.int32()))], ["y", "share", "at", "n"])

    learned = bags.mapInArrow(narrow, "y int, share double, at array<int>, n array<int>").collect()  # at most ``sample`` rows of at most ``features`` numbers
    bags.unpersist()
    y, share = np.array([r["y"] for r in learned]), np.array([r["share"] for r in learned])
    grades = y * (1 + (share > np.median(share[y == 1])))
    if not (grades == 2).any():
        grades = y
    where = np.repeat(np.arange(len(learned)), [len(r["at"]) for r in learned])
    cols = np.array([k for r in learned for k in r["at"]], np.int64)
    values = 1 + np.log(np.array([k for r in learned for k in r["n"]], float))
    weights, thresholds = ordinal(where, cols, values, grades, len(table))
    return Ordinal(table, weights, thresholds)


def grade(docs: DataFrame, model: Ordinal, *, cut: float = CUT) -> DataFrame:
    """doc_id, severity (expected grade), score (P(grade > 0)), grade (most likely) and toxic (score >= cut) of each document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            up = sent.value.above(logits(*text_buffer(b.column(1)), sent.value))
            parts = -np.diff(np.concatenate([np.ones((len(up), 1)), up, np.zeros((len(up), 1))], 1), axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(up.sum(1)), pa.array(up[:, 0]), pa.array(parts.argmax(1).astype(np.int32)), pa.array(up[:, 0] >= cut)], ["doc_id", "severity", "score", "grade", "toxic"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, severity double, score double, grade int, toxic boolean")


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return grade(docs, fit(docs, labels))
