from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from texts import corpus, frame, lower, words

from swelter.llm import chat, licenses, neighbours, quality, toxicity

PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


# --- chat


def test_template_round_trip():
    render = chat.compile_template()
    rng = random.Random(0)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "/s>", "a", "\n", "[", "INST]", "é"]
    for _ in range(400):
        messages = [{"role": rng.choice(["user", "assistant", "a\nb", "[INST]", ""]), "text": "".join(rng.choices(parts, k=rng.randint(0, 12)))} for _ in range(rng.randint(0, 5))]
        pieces = list(render(iter(messages)))
        for text in (["".join(p for p, _ in pieces)], [p for p, _ in pieces]):
            reader = chat.Reader()
            assert [t for p in text for t in reader.feed(p)] == [(m["role"], m["text"]) for m in messages]
        assert "".join(chat.unescape(p) for p, on in pieces if on) == "".join(m["text"] for m in messages if m["role"] == "assistant")


def test_template_language():
    run = lambda source, **scope: "".join(t for t, _ in chat._block(chat.fold(chat.parse(source)))(scope, False))
    assert run("{{ 'a' + 'b' | upper }}{% if x == 1 %}one{% elif x %}some{% else %}none{% endif %}", x=2) == "aBsome"
    assert run("{% for m in ms %}{{ loop.index }}{{ m.t }}{% if not loop.first and m.t != 'q' %}!{% endif %}{% endfor %}", ms=[{"t": "p"}, {"t": "r"}]) == "1p2r!"
    assert run("{{ missing.deep }}{{ none or 'x' }}") == "x"
    assert chat.fold(chat.parse("a{{ 'b' }}{% if 1 == 1 %}c{% else %}d{% endif %}")) == (chat.Emit(chat.Const("abc")),)
    for bad in ("{{ a.__class__ }}", "{{ x | system }}", "{% import os %}", "{{ f() }}", "{% for x in y %}", "{{ 'a }}"):
        with pytest.raises(chat.TemplateError):
            chat.parse(bad)


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b\\</s>"), (1, 0, "user", "a"), (2, 0, None, None), (None, 0, "assistant", "n"), (3, 0, "user", "t"), (3, 0, "user", "t"), (4, None, "assistant", "x" * 5000)]
    got = {r.conv_id: r for r in chat.digest_conversations(spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, piece int")).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\na\nassistant\nb\\</s>\n") and got[1].loss_sha256 == sha("b\\</s>") and got[1].loss_chars == 6
    assert got[1].formatted_chars == len("<s>[INST]user[/INST]a</s><s>[INST]assistant[/INST]b\\\\\\</s></s>")
    assert got[2].turns_sha256 == sha("\n\n") and got[3].n_turns == 2 and got[None].loss_chars == 1 and got[4].loss_chars == 5000
    text = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).where("conv_id = 1").orderBy("piece").collect()
    assert "".join(r.text for r in text if r.generated) == chat.escape("b\\</s>")
    assert chat.digest_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# --- licences


def places(text):
    w = PLAIN.findall(lower(text))
    found = [(i, len(p.split()), label) for p, label in licenses.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), len(found), min((f[0] for f in found), default=None), max((f[0] for f in found), default=None), ",".join(sorted({f[2] for f in found}))


def test_licences(spark):
    rows = corpus() + [
        (300, "CC BY 4.0 and cc,by; the GNU General  Public License, version 3 or later. All rights reserved"),
        (301, "Licensed under CC BY-NC 4.0. SPDX-License-Identifier: GPL-2.0-or-later"),
        (302, "Licensed under the Apache License, Version 2.0. Copyright (c) 2020 X. Acc by bccby xcc by"),
        (303, "Kcc by K all RIGHTS reserved all rights reserved CC0 cc by"),
        (304, "Released under the MIT License." * 40),
    ]
    got = licenses.scan(frame(spark, rows)).collect()
    key = lambda r: str(r)
    want = sorted(((doc, *places(t)) for doc, t in rows), key=key)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == want
    by = {r.doc_id: r for r in got}
    assert by[300].labels == "cc-by,cc-by-4.0,gpl,gpl-3.0-or-later,reserved"
    assert by[301].labels == "cc-by,cc-by-nc-4.0,gpl-2.0-or-later,licensed" and by[301].score == 1.0
    assert by[302].labels == "apache-2.0,copyright,licensed" and by[304].labels.split(",")[-1] == "mit"
    assert by[200].score == 0 and all(0 <= r.score <= 1 for r in got)
    assert len(licenses.rules()) > 300
    assert licenses.scan(frame(spark, [])).count() == 0


def test_rules_are_reachable_through_their_keywords():
    """Every rule's keyword spellings hold a word that its regex needs; checked on a text made for it."""
    for _, label, keyword, _ in licenses.rules():
        assert licenses._spellings(keyword), label


def sample(rng, parsed):
    """A random match of a parsed regex."""
    out = ""
    for op, arg in parsed:
        match str(op):
            case "LITERAL":
                out += chr(arg)
            case "BRANCH":
                out += sample(rng, rng.choice(arg[1]))
            case "SUBPATTERN":
                out += sample(rng, arg[-1])
            case "MAX_REPEAT":
                out += "".join(sample(rng, arg[2]) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 1))))
            case "IN":
                kind, value = rng.choice(arg)
                out += chr(value) if str(kind) == "LITERAL" else {"CATEGORY_SPACE": " ", "CATEGORY_DIGIT": "7"}[str(value)] if str(kind) == "CATEGORY" else chr(value[0])
            case "ASSERT_NOT":
                pass
            case _:
                raise AssertionError(op)
    return out


def test_every_match_of_a_rule_holds_its_keyword():
    rng = random.Random(4)
    head, tail = licenses._bounded("|").split("|", 1)
    missed = set()
    for _, label, keyword, regex in licenses.rules():
        assert regex.startswith(head) and regex.endswith(tail)
        inner = regex[len(head) : -len(tail)]
        for _ in range(60):
            text = sample(rng, re._parser.parse(inner))
            if not set(PLAIN.findall(lower(text))) & set(licenses._spellings(keyword)):
                missed.add((label, text))
    assert not missed


def test_licences_found_by_their_own_words(spark):
    texts = {"unlicense": "the Unlicense", "licensed": "It is released under the terms of the", "commercial": "noncommercial use", "no-ai": "may not be used to train", "wtfpl": "Do What the Fuck You Want to Public License", "php": "PHP License3.0"}
    got = {r.doc_id: r.labels for r in licenses.scan(frame(spark, list(enumerate(texts.values())))).collect()}
    assert all(label in got[i] for i, label in enumerate(texts))


# --- neighbours


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1200, 16)).astype(np.float32)
    x[7] = x[300]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(5000, None), (5100, [0.0] * 16), (5200, [float("nan")] * 16), (5300, [1.0] * 3), (None, [1.0] * 16), (300, [float(v) for v in x[300]])]
    frame_ = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = neighbours.search(frame_, shard_rows=400, query_rows=8).collect()
    hits = total = 0
    for q in range(0, 1200, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        want = [int(i) for i in np.lexsort((np.arange(len(x)), d)) if i != q][:10]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11))
        assert all(abs(r.score - d[r.vec_id]) < 1e-12 for r in mine) and [r.score for r in mine] == sorted(r.score for r in mine)
        hits, total = hits + len({r.vec_id for r in mine} & set(want)), total + 10
    assert hits / total >= 0.9
    assert {r.query_id for r in got} == set(range(0, 1200, 100))
    few = neighbours.search(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")).collect()
    assert [(r.rank, r.vec_id) for r in few] == [(1, 1), (2, 2)]
    assert neighbours.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_neighbours_of_ids_with_several_vectors(spark):
    """Rows of one id are rows of their own: neither is a neighbour of the other, and both answer for a query's id."""
    rows = [(0, [0.0, 1.0]), (0, [9.0, 1.0]), (1, [0.0, 2.0]), (2, [9.0, 3.0]), (2, [9.0, 3.0]), (2, [50.0, 1.0])]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got][:2] == [(0, 1, 1, 1.0), (0, 2, 2, 2.0)]
    assert all(r.vec_id != 0 for r in got) and [r.rank for r in got] == list(range(1, len(got) + 1))


def test_neighbours_of_isotropic_vectors_in_several_shards(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 64))
    rows = [(i, [float(v) for v in x[i]]) for i in range(1500)] + [(7, [float(v) for v in x[7]])]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=50, shard_rows=400, query_rows=7).collect()
    hits = 0
    for q in range(0, 1500, 50):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11)) and all(abs(r.score - d[r.vec_id]) < 1e-12 for r in mine)
        hits += len({r.vec_id for r in mine} & set(np.argsort(d)[:10].tolist()))
    assert hits / 300 >= 0.9


# --- quality and toxicity


def labelled(seed=1, n=500):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad, toxic = i % 4 == 0, i % 5 == 0
        text = words(rng, rng.randint(30, 120))
        if bad:
            text = " | ".join(text.upper().split()) + " ### $$$"
        if toxic:
            text += " " + " ".join(rng.choices(["idiot", "moron", "scum"], k=1 + i % 7))
        docs.append((i, text))
        labels.append((i, int(not bad), int(toxic)))
    return docs, labels


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled()
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, score string")
    got = quality.classify(frame(spark, docs + corpus()[12:]), marks).collect()
    assert len(got) == len(docs) + len(corpus()[12:])
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.classify(frame(spark, corpus()), none).collect()} == {0.5}
    assert quality.classify(frame(spark, []), none).count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(n=900)
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, grade string")
    got = {r.doc_id: r for r in toxicity.assess(frame(spark, docs), marks).collect()}
    import zlib

    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].toxic == (i % 5 == 0) for i in held]) > 0.97
    few, many = ([got[i].severity for i in range(0, 900, 5) if (1 + i % 7) == n] for n in (1, 7))
    assert np.mean(many) > np.mean(few)
    none = toxicity.assess(frame(spark, corpus()), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r.severity for r in none.collect()} == {0.0} or all(r.severity < 1e-9 for r in none.collect())
    assert toxicity.assess(frame(spark, []), marks).count() == 0


def test_toxicity_learns_a_repeated_document_once(spark):
    docs, labels = labelled(n=120)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    once = toxicity.fit(frame(spark, docs), marks)
    often = toxicity.fit(frame(spark, docs + [docs[7]] * 300 + [(None, "no id")]), marks)
    assert (once.words == often.words).all() and np.allclose(once.weights, often.weights) and np.allclose(once.thresholds, often.thresholds)


def test_ordinal_shares_weights_across_thresholds():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 2))
    grades = np.digitize(6 * x[:, 0] - 2 * x[:, 1] + rng.logistic(0, 0.3, 3000), [1.0, 2.5])
    rows, cols = np.repeat(np.arange(3000), 2), np.tile([0, 1], 3000)
    w, t = toxicity.ordinal(rows, cols, x.ravel(), grades, 2, steps=1500)
    assert t[0] < t[1] and w[0] > 0 > w[1] and abs(w[0] / w[1] + 3) < 0.5
