"""The pipeline's stages, each against brute force on what the stage before kept."""

from __future__ import annotations

import collections

import pytest
from test_models_and_rows import labelled
from test_text_operators import leaks_expected, near_expected
from texts import corpus, words

import corpus_pipeline

COLUMNS = list(corpus_pipeline.COLUMNS)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    import random

    rng = random.Random(9)
    docs, labels = labelled(n=260)
    shared = words(rng, 120)
    rows = docs + [(1000 + (i or 0), t) for i, t in corpus() if i is not None] + [(None, words(rng, 40)), (None, None)]
    rows += [(3000 + i, words(rng, 60) + " " + shared + " " + words(rng, 60)) for i in range(4)]
    items = [(1, " ".join(docs[3][1].split()[2:20])), (2, "no such words here at all")]
    root = str(tmp_path_factory.mktemp("tables"))
    put = lambda name, data, shape: spark.createDataFrame(data, shape).write.parquet(f"{root}/{name}.parquet")
    put("documents", [(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    put("labels", labels, "doc_id long, quality int, toxic int")
    put("benchmark", items, "item_id long, text string")
    return root, items


def test_stages(spark, base):
    root, items = base
    docs = spark.read.parquet(f"{root}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, root).write.parquet(path := f"{root}/stage{k}")
        before, docs = docs, spark.read.parquet(path)
        kept[name] = [(r.doc_id, r.text) for r in before.collect()], docs.collect()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == COLUMNS
    before, after = kept["quality"]
    bad = {i for i in range(0, 260, 4)}
    left = {r.doc_id for r in after}
    assert len(bad & left) <= 3 and len(set(range(260)) - bad - left) <= 3
    before, after = kept["near_duplicates"]
    want = {i for i, _, _, stays in near_expected(before, corpus_pipeline.SHINGLE) if stays and i is not None}
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted(want)
    assert sum(r.doc_id is None for r in after) == sum(i is None for i, _ in before)
    before, after = kept["repeated_bytes"]
    texts = [(t or "").encode() for _, t in before]
    n = corpus_pipeline.REPEATED
    count = collections.Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    cut = []
    for (doc, _), t in zip(before, texts):
        gone = {j for i in range(len(t) - n + 1) if count[t[i : i + n]] > 1 for j in range(i, i + n)}
        cut.append((doc, bytes(b for j, b in enumerate(t) if j not in gone).decode(errors="ignore")))
    assert sorted(cut, key=str) == sorted(((r.doc_id, r.text) for r in after), key=str)
    assert any(len(a) < len((b or "")) for (_, a), (_, b) in zip(cut, before))
    before, after = kept["decontamination"]
    clean = [x[0] for x in leaks_expected(before, items) if not x[-1]]
    assert sorted((r.doc_id for r in after), key=str) == sorted(clean, key=str) and len(after) < len(before)
    before, after = kept["packing"]
    assert collections.Counter(r.doc_id for r in after if r.piece == 0) == collections.Counter(i for i, _ in before)


def test_run_and_contract(spark, base):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_bytes", "decontamination", "packing"]
    assert corpus_pipeline.run(spark, base[0]).count() > 0


CLASHING = ("x", "score", "k", "marks", "contaminated", "once")


@pytest.mark.parametrize("n", [0, 6])
def test_empty_tables_and_clashing_columns(spark, tmp_path, n):
    """No labels and no benchmark: nothing is rejected; extra columns named like inner ones are ignored, no documents give no pieces."""
    import random

    rng = random.Random(3)
    rows = [(i, words(rng, 70 + i), "en", "s", 5, *("clash" for _ in CLASHING)) for i in range(n)]
    put = lambda name, data, shape: spark.createDataFrame(data, shape).write.parquet(f"{tmp_path}/{name}.parquet")
    put("documents", rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING))
    put("labels", [], "doc_id long, quality int, toxic int")
    put("benchmark", [], "item_id long, text string")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == COLUMNS
        assert sorted((r.doc_id, r.text) for r in out.collect()) == [r[:2] for r in rows]
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == list(range(n))
