"""The two classifiers against their formulas worked out by hand, and the awkward labels they must take."""

from __future__ import annotations

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
from test_models_and_rows import PLAIN, labelled
from texts import frame, lower

from swelter.llm import quality, toxicity
from swelter.llm.common import PLAIN_WORDS, Words, text_buffer

LABELS = "doc_id long, quality int, toxic int"


def held_out(i) -> bool:
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_quality_scores_by_hand(spark):
    docs, labels = labelled(n=240)
    labels += [(1, None, None), (2, 7, 1), (3, 0, 0), (3, 0, 0), (None, 1, 0), (99_999, 1, 0)]
    docs += [(4, docs[4][1]), (5, "another text of a repeated id"), (None, "no id"), (600, None), (601, "")]
    got = quality.classify(frame(spark, docs), spark.createDataFrame(labels, LABELS)).collect()
    x = quality.statistics(*text_buffer(pa.array([t for _, t in docs])))
    rows = [(x[k], y) for i, y, _ in labels if i is not None and y in (0, 1) and not held_out(i) for k, (d, _) in enumerate(docs) if d == i]
    own = [np.stack([v for v, y in rows if y == c]) for c in (0, 1)]
    scatter = [(v - v.mean(0)).T @ (v - v.mean(0)) for v in own]
    pooled = sum(scatter) / len(rows)
    logs = []
    for v, s in zip(own, scatter):
        cov = (1 - quality.SHRINK) * s / len(v) + quality.SHRINK * pooled
        cov = (1 - quality.RIDGE) * cov + (quality.RIDGE * np.trace(cov) / len(cov) + 1e-9) * np.eye(len(cov))
        gap = x - v.mean(0)
        logs.append(-0.5 * np.einsum("ni,ij,nj->n", gap, np.linalg.inv(cov), gap) - 0.5 * np.linalg.slogdet(cov)[1])
    want = 1 / (1 + np.exp(-np.clip(logs[1] - logs[0] + math.log((len(own[1]) + 0.5) / (len(own[0]) + 0.5)), -500, 500)))
    assert len(got) == len(docs)
    mine = sorted((str(r.doc_id), r.score) for r in got)
    theirs = sorted((str(d), float(s)) for (d, _), s in zip(docs, want))
    assert [a for a, _ in mine] == [a for a, _ in theirs] and np.allclose([b for _, b in mine], [b for _, b in theirs], atol=1e-6)
    assert all(r.held_out == (r.doc_id is not None and held_out(r.doc_id)) for r in got)


def test_quality_with_one_class(spark):
    docs, labels = labelled(n=60)
    one = spark.createDataFrame([(i, 1, 0) for i, _, _ in labels], LABELS)
    scores = {r.score for r in quality.classify(frame(spark, docs), one).collect()}
    assert len(scores) == 1 and scores.pop() > 0.9


def test_toxicity_scores_by_hand(spark):
    docs, labels = labelled(n=600)
    labels += [(1, 1, None), (2, 1, 9), (5, 1, 0), (5, 1, 1), (None, 1, 1), (99_999, 1, 1)]
    docs += [(10, docs[10][1]), (None, "idiot moron scum"), (700, None), (701, ""), (702, "idiot " * 3000)]
    table = frame(spark, docs)
    marks = spark.createDataFrame(labels, LABELS)
    model = toxicity.fit(table, marks)
    got = toxicity.grade(table, model).collect()
    assert len(got) == len(docs)
    weight = dict(zip(model.words.tolist(), model.weights.tolist()))

    def hashed(words):
        joined = np.frombuffer(" ".join(words).encode(), np.uint8)
        return Words(joined, np.array([0, len(joined)]), PLAIN_WORDS).hashes.tolist()

    want = collections.defaultdict(list)
    for doc, text in docs:
        count = collections.Counter(PLAIN.findall(lower(text)))
        names = list(count)
        total = sum(weight.get(h, 0.0) * (1 + math.log(count[w])) for w, h in zip(names, hashed(names) if names else []))
        above = [1 / (1 + math.exp(t - total)) for t in model.thresholds]
        want[doc].append((round(sum(above), 6), round(above[0], 6)))
    mine = collections.defaultdict(list)
    for r in got:
        mine[r.doc_id].append((round(r.severity, 6), round(r.score, 6)))
    assert {k: sorted(v) for k, v in mine.items()} == {k: sorted(v) for k, v in want.items()}
    # one weight vector serves all thresholds, and held-out severities rise with the number of toxic words
    assert (np.diff(model.thresholds) >= 0).all()
    by = {r.doc_id: r.severity for r in got if r.doc_id is not None and held_out(r.doc_id) and r.doc_id < 600}
    means = [np.mean([s for i, s in by.items() if i % 5 == 0 and (1 + i % 7) in n]) for n in ((1, 2), (3, 4, 5), (6, 7))]
    assert means == sorted(means) and np.mean([s for i, s in by.items() if i % 5]) < means[0]
