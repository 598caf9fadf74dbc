from __future__ import annotations

import collections
import hashlib
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from texts import corpus, frame, lower, words

from swelter.llm import decontamination, fuzzy_passages, near_dedup, packing, repeated_bytes
from swelter.llm.common import BLANK_WORDS, PLAIN_WORDS, Words, selected, text_buffer, window_minima
from swelter.llm.components import components
from swelter.llm.queries import tokenizer_files
from swelter.llm.run_index import RunIndex

DIR = "/root/testdata/sf0.001"
PLAIN, BLANK = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"), re.compile("[^\x20\x09-\x0d]+")


def test_words_match_the_definitions():
    texts = [t or "" for _, t in corpus()]
    data, offsets = text_buffer(pa.array(texts))
    for kind, pattern in ((PLAIN_WORDS, PLAIN), (BLANK_WORDS, BLANK)):
        w = Words(data, offsets, kind)
        found = [[data[a:b].tobytes().decode() for a, b in zip(w.starts[i:j], w.ends[i:j])] for i, j in zip(w.first, w.first[1:])]
        assert [[lower(x) for x in ws] for ws in found] == [pattern.findall(lower(t)) for t in texts]


def test_winnowing_keeps_the_minimum_of_every_window():
    x = np.random.default_rng(0).integers(0, 50, 200).astype(np.uint64)
    for w in (1, 2, 5, 7):
        assert window_minima(x, w).tolist() == [x[i : i + w].min() for i in range(len(x) - w + 1)]
        at = set(selected(x, w).tolist())
        assert all(any(j in at and x[j] == x[i : i + w].min() for j in range(i, i + w)) for i in range(len(x) - w + 1))


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (200, 300), (7, 7), (500, 400)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[i] for i in range(1, 61)} == {1}
    assert {got[i] for i in (100, 200, 300)} == {100}
    assert got[500] == got[400] == 400


# --- near-duplicates


def near_expected(rows, size=2):
    sets = []
    for _, t in rows:
        w = BLANK.findall(lower(t))
        sets.append(set(zip(*(w[k:] for k in range(size)))) if len(w) >= size else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        component = min(ids, default=None)
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=str)


@pytest.mark.parametrize(("small", "block"), [(near_dedup.SMALL, near_dedup.BLOCK_BYTES), (1, near_dedup.BLOCK_BYTES), (1, 900)])
def test_near_duplicates(spark, monkeypatch, small, block):
    """Also with every bucket of two or more treated as a large one, in one block or in many."""
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", block)
    rows = corpus()
    got = near_dedup.near_duplicates(frame(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == near_expected(rows)


def test_large_group_of_near_copies_is_one_component(spark):
    import random

    rng = random.Random(4)
    base = words(rng, 120).split()
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randint(1, 8)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(copy)))
    got = near_dedup.near_duplicates(frame(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == near_expected(rows)


def test_many_unlinked_texts_in_one_bucket(spark, monkeypatch):
    """Half of each text is one common passage, the rest its own, and some are near copies of each other."""
    import random

    monkeypatch.setattr(near_dedup, "SMALL", 4)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 20_000)
    rng = random.Random(11)
    common = words(rng, 150)
    rows = [(i, common + " " + " ".join(f"u{rng.randrange(100_000)}" for _ in range(60))) for i in range(120)]
    rows += [(1000 + i, t + f" tail{i}") for i, t in rows[::10]]
    got = near_dedup.near_duplicates(frame(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == near_expected(rows)


# --- repeated bytes


def bytes_expected(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(bytes(a for a, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("large", "hot"), [(repeated_bytes.LARGE, 1), (900, 1), (repeated_bytes.LARGE, 60), (900, 60), (repeated_bytes.LARGE, repeated_bytes.HOT)])
def test_repeated_bytes(spark, monkeypatch, large, hot):
    """Also with most anchors taking the way of large ones; with no, some and all anchors taking that of hot ones."""
    monkeypatch.setattr(repeated_bytes, "LARGE", large)
    monkeypatch.setattr(repeated_bytes, "HOT", hot)
    rows = corpus()
    rows += [(300 + i, rows[i][1] + " " + ("shared passage number %d " % (i % 2)) * 30) for i in range(6)]
    got = repeated_bytes.repeated_bytes(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == bytes_expected(rows, repeated_bytes.LENGTH)


def test_run_index_against_brute_force():
    import random

    rng = random.Random(3)
    for turn in range(150):
        base = bytes(rng.choices(b"abc\x00\xff" if turn % 2 else b"a", k=rng.randint(0, 40)))
        texts = [base[rng.randint(0, 5) :] + bytes(rng.choices(b"ab\x00", k=rng.randint(0, 6))) for _ in range(rng.randint(1, 6))]
        length = rng.choice([1, 3, 8, 15])
        count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
        want = [[i for i in range(len(t) - length + 1) if count[t[i : i + length]] > 1] for t in texts]
        assert [x.tolist() for x in RunIndex(texts).repeated(length)] == want


# --- decontamination


def leaks_expected(rows, items, window=10):
    grams = collections.defaultdict(set)
    for item, t in items:
        w = PLAIN.findall(lower(t))
        if item is not None and w:
            n = min(window, len(w))
            for i in range(len(w) - n + 1):
                grams[tuple(w[i : i + n])].add(str(item))
    out = []
    for doc, t in rows:
        w = PLAIN.findall(lower(t))
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in grams:
                    hit.update(range(i, i + n))
                    found |= grams[g]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bound", [decontamination.BROADCAST_BYTES, 0])
def test_decontamination(spark, bound):
    rows = corpus()
    long = rows[8][1].split()
    items = [(1, " ".join(long[3:15])), (2, rows[0][1]), (2, "one"), (10, "É ü"), (3, None), (4, " ,;"), (None, rows[1][1]), (5, "w1 w2 w3"), (6, " ".join(long[5:12]))]
    rows += [(400, "Before, " + " ".join(long[2:14]).upper() + " after"), (401, "and w1, W2; w3 w1 w2 w3"), (402, "just one")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.decontaminate(frame(spark, rows), benchmark, broadcast_bytes=bound).collect()
    assert sorted((tuple(r) for r in got), key=str) == leaks_expected(rows, items)


# --- packing


def test_both_tokenizers_agree():
    encode = packing.Encoder(*tokenizer_files())
    for c in [*range(0, 0x3000), *range(0x3000, 0xD800, 37), *range(0xE000, 0x110000, 4099)]:
        s = f"a{chr(c)}b {chr(c)}{chr(c)}1{chr(c)} .{chr(c)}"
        assert encode.fast.encode_ordinary(s) == encode.exact.encode(s, add_special_tokens=False).ids, hex(c)


def test_cut_puts_the_remainder_first():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(4, 4) == [(0, 4)]


def test_packing(spark):
    from tokenizers import Tokenizer

    rows = corpus()
    tokens = Tokenizer.from_file(tokenizer_files()[0])
    got = packing.pack(frame(spark, rows).repartition(3), *tokenizer_files()).collect()
    want = collections.Counter()
    for doc, t in rows:
        ids = [*tokens.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        for k, s in enumerate([0, *range(first, len(ids), 1024)]):
            piece = ids[s : first if k == 0 else s + 1024]
            want[(doc, k, s, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    filled = collections.defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r.length for r in got)
    assert len(filled) <= -(-total // 1024) + 1


def test_packing_over_several_levels(spark):
    """Forty partitions come together two at a time, nearly full sequences leave at once, and little room is lost."""
    import random

    rng = random.Random(2)
    rows = [(i, words(rng, rng.randint(1, 150))) for i in range(600)] + [(1000, words(rng, 60_000))]
    held = packing.HELD
    packing.HELD = 50
    try:
        got = packing.pack(frame(spark, rows).repartition(40), *tokenizer_files(), length=256, fan_in=2).collect()
    finally:
        packing.HELD = held
    filled = collections.defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 256
    assert len({r.sequence_id >> 56 for r in got}) >= 3
    assert len(filled) <= 1.03 * sum(r.length for r in got) / 256 + 1
    pieces = collections.Counter((r.doc_id, r.piece) for r in got)
    assert max(pieces.values()) == 1 and len({r.doc_id for r in got}) == len(rows)


def test_packing_a_text_of_millions_of_tokens(spark):
    """All pieces but the first are full and stand alone; the rest of the sequences hold the short texts."""
    n = 2_500_000
    got = packing.pack(frame(spark, [(1, "a b " * (n // 2)), (2, None), (3, "short")]), *tokenizer_files()).collect()
    own = sorted((r.piece, r.start, r.length) for r in got if r.doc_id == 1)
    assert [p for p, *_ in own] == list(range(len(own))) and all(x == 1024 for *_, x in own[1:])
    assert all(s + x == t for (_, s, x), (_, t, _) in zip(own, own[1:], strict=False)) and own[-1][1] + own[-1][2] > n
    assert len({r.sequence_id for r in got}) <= -(-sum(r.length for r in got) // 1024) + 1


# --- fuzzy passages


def test_fuzzy_passages(spark):
    import random

    rng = random.Random(5)
    fresh = lambda n: [f"v{rng.randrange(50_000)}" for _ in range(n)]
    passage, edited = fresh(60), fresh(80)
    changed = [w for k, w in enumerate(edited) if k % 19] + ["tail"]
    rows = [(i, " ".join(fresh(200))) for i in range(10)]
    rows += [(100 + i, " ".join(fresh(40) + passage + fresh(50))) for i in range(3)]
    rows += [(200, " ".join(fresh(30) + edited + fresh(20))), (201, " ".join(fresh(60) + changed + fresh(20)))]
    rows += [(300 + i, " ".join(fresh(40) + passage[:30] + fresh(50))) for i in range(2)]
    copy = " ".join(fresh(120))
    rows += [(400, copy), (401, copy), (None, copy), (500, None), (501, ""), (502, "short"), (503, "short")]
    got = {r.doc_id: r for r in fuzzy_passages.fuzzy_passages(frame(spark, rows)).collect()}
    assert set(got) == {100, 101, 102, 200, 201, 400, 401, None}
    assert all(tuple(got[100 + i].spans[0]) == (40, 100) for i in range(3))
    assert got[400].n_repeated == 120 and got[201].partners == [200]


@pytest.mark.skipif(not os.path.isdir(DIR), reason="the driver's tables are not here")
def test_fuzzy_passages_against_brute_force(spark):
    """Every document with 50 words in a row that another one has is found, at those words; every passage has words of other places."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    texts = {r.doc_id: PLAIN.findall(lower(r.text)) for r in docs.collect()}
    runs, short = collections.defaultdict(set), collections.Counter()
    for doc, w in texts.items():
        for k in range(len(w) - 49):
            runs[tuple(w[k : k + 50])].add((doc, k))
        short.update({tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) > 3 else ())
    exact = [place for places in runs.values() if len({doc for doc, _ in places}) > 1 for place in places]
    got = {r.doc_id: r for r in fuzzy_passages.fuzzy_passages(docs).collect()}
    assert len({doc for doc, _ in exact}) > 20
    assert all(any(s.s < k + 50 and s.e > k for s in got[doc].spans) for doc, k in exact)
    inside = sum(sum(max(0, min(s.e, k + 50) - max(s.s, k)) for s in got[doc].spans) for doc, k in exact)
    assert inside >= 0.95 * 50 * len(exact)
    for r in got.values():
        assert r.n_words == len(texts[r.doc_id]) and r.n_repeated == sum(s.e - s.s for s in r.spans)
        for s in r.spans:
            w = texts[r.doc_id][s.s : s.e]
            common = {k + j for k in range(len(w) - 3) if short[tuple(w[k : k + 4])] > 1 or r.partners == [r.doc_id] for j in range(4)}
            assert len(w) >= 45 and len(common) >= 0.4 * len(w)


def test_fuzzy_passages_of_a_very_long_text(spark):
    """A text of 300,000 words that holds a passage of a short one near its end."""
    rng = np.random.default_rng(4)
    long, passage = [f"v{i}" for i in rng.integers(0, 1 << 40, 300_000)], [f"p{i}" for i in range(80)]
    rows = [(1, " ".join(long[:290_000] + passage + long[290_000:])), (2, " ".join(["x", *passage, "y"])), (3, " ".join(long[:30]))]
    got = {r.doc_id: r for r in fuzzy_passages.fuzzy_passages(frame(spark, rows)).collect()}
    assert set(got) == {1, 2} and got[1].n_words == 300_080 and [(s.s, s.e) for s in got[1].spans] == [(290_000, 290_080)]


def test_chains_prefer_collinear_matches():
    x = np.array([0, 10, 20, 30, 40, 15, 25])
    y = np.array([100, 110, 120, 130, 140, 10, 500])
    (chain,) = fuzzy_passages.chains(x, y, least=20)
    assert chain.tolist() == [0, 1, 2, 3, 4]


# --- empty tables


def test_empty_tables(spark):
    none = frame(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    assert near_dedup.near_duplicates(none).count() == 0
    assert repeated_bytes.repeated_bytes(none).count() == 0
    assert decontamination.decontaminate(none, items).count() == 0
    assert decontamination.decontaminate(frame(spark, [(1, "a b c")]), items).collect()[0].n_hit == 0
    assert packing.pack(none, *tokenizer_files()).count() == 0
    assert fuzzy_passages.fuzzy_passages(none).count() == 0


# --- fuzzy passages: whole results


def fuzzy(spark, rows):
    return {r.doc_id: r for r in fuzzy_passages.fuzzy_passages(frame(spark, rows)).collect()}


def fresh_words(seed):
    import random

    rng = random.Random(seed)
    return lambda n: [f"v{rng.randrange(50_000)}" for _ in range(n)]


def test_fuzzy_passages_of_a_repeated_line(spark):
    fresh = fresh_words(6)
    line, lead = fresh(20), fresh(60)
    rows = [(1, fresh(40) + line * 5 + fresh(40)), (2, fresh(70) + line * 5 + fresh(40)), (3, fresh(30) + lead), (4, lead[5:15] + fresh(100) + lead + fresh(20) + lead)]
    got = fuzzy(spark, [(i, " ".join(w)) for i, w in rows])
    assert set(got) == {1, 2, 3, 4}
    assert [tuple(s) for s in got[1].spans] == [(40, 140)] and [tuple(s) for s in got[2].spans] == [(70, 170)]
    assert [tuple(s) for s in got[3].spans] == [(30, 90)] and [tuple(s) for s in got[4].spans] == [(110, 170), (190, 250)]


def test_fuzzy_passages_of_one_chain(spark):
    fresh = fresh_words(7)
    one, two = fresh(60), fresh(60)
    rows = [(i, " ".join(fresh(10 * i) + one + fresh(60) + two + fresh(30))) for i in (1, 2)]
    got = fuzzy(spark, rows)
    assert [tuple(s) for s in got[1].spans] == [(10, 70), (130, 190)] and got[2].n_repeated == 120


def test_alignment_finds_the_dense_part_of_a_loose_segment():
    x = np.arange(200, dtype=np.uint64)
    y = x.copy()
    y[np.arange(0, 200)[(np.arange(200) % 4 == 3) & ((np.arange(200) < 60) | (np.arange(200) >= 120))]] += np.uint64(1000)
    ((s, e, t, f),) = fuzzy_passages.aligned(x, y, np.arange(60, 116), np.arange(60, 116))
    assert s <= 60 and e >= 120 and (s, e) == (t, f) and (x[s:e] == y[s:e]).mean() >= 0.8


def test_chains_leave_what_lies_in_their_gaps():
    steps = np.arange(0, 61, 4)
    x, y = np.concatenate([steps, steps + 100, steps + 200, steps + 300]), np.concatenate([steps, steps + 200, steps + 100, steps + 300])
    found = fuzzy_passages.chains(x, y)
    assert set(np.concatenate(found)) == set(range(len(x))) and len(found) == 2


def test_fuzzy_passages_with_many_edits(spark):
    fresh = fresh_words(8)
    rows = []
    for i in range(60):
        passage, every = fresh(60), (8, 10, 12)[i % 3]
        edited = [fresh(1)[0] if k % every == every - 1 else w for k, w in enumerate(passage)]
        rows += [(2 * i, " ".join(fresh(40) + passage + fresh(40))), (2 * i + 1, " ".join(fresh(30) + edited + fresh(50)))]
    assert set(fuzzy(spark, rows)) == set(range(120))


def test_fuzzy_passages_beside_a_hub_that_has_only_the_seeds(spark):
    """A passage whose seeds many unrelated texts hold: pieces of it stand in twenty texts each, and two hold it whole."""
    fresh = fresh_words(9)
    passage = fresh(60)
    rows = [(1000 + 20 * p + i, " ".join(fresh(20) + passage[p : p + 20] + fresh(30))) for p in range(0, 50, 10) for i in range(20)]
    rows += [(i, " ".join(fresh(10 * i) + passage + fresh(40))) for i in (1, 2)]
    got = fuzzy(spark, rows)
    assert set(got) == {1, 2} and got[1].partners == [2]
    assert [tuple(s) for s in got[1].spans] == [(10, 70)]


@pytest.mark.parametrize(("size", "times"), [(27, 3), (20, 4), (20, 6), (40, 2)])
def test_fuzzy_passages_of_short_repeated_lines(spark, size, times):
    """Three texts that share a passage made of one line, and nothing else."""
    fresh = fresh_words(10 + size + times)
    passage = fresh(size) * times
    rows = [(i, " ".join(fresh(10 * i) + passage + fresh(30))) for i in (1, 2, 3)]
    got = fuzzy(spark, rows)
    assert [[tuple(s) for s in got[i].spans] for i in (1, 2, 3)] == [[(10 * i, 10 * i + size * times)] for i in (1, 2, 3)]


def test_fuzzy_passages_with_words_put_in(spark):
    fresh = fresh_words(11)
    passage = fresh(120)
    longer = [x for k, w in enumerate(passage) for x in ([w, fresh(1)[0]] if k % 8 == 7 else [w])]
    got = fuzzy(spark, [(1, " ".join(fresh(30) + passage + fresh(30))), (2, " ".join(fresh(50) + longer + fresh(20)))])
    assert [tuple(s) for s in got[1].spans] == [(30, 150)] and [tuple(s) for s in got[2].spans] == [(50, 184)]


def test_fuzzy_passages_leave_a_common_line(spark):
    """A line of 30 words in many texts is no passage, two of them beside each other in some texts are one."""
    fresh = fresh_words(12)
    one, two = fresh(30), fresh(30)
    rows = [(i, " ".join(fresh(20) + one + fresh(40) + two + fresh(5))) for i in range(60)]
    rows += [(1000 + i, " ".join(fresh(15) + one + two + fresh(20))) for i in range(25)]
    rows += [(2000, ""), (2001, " ".join(["of"] * 80)), (2002, " ".join(fresh(30) + ["of"] * 70 + fresh(30))), (2003, " ".join(["of"] * 20))]
    got = fuzzy(spark, rows)
    assert set(got) == {2001, 2002} | {1000 + i for i in range(25)}
    assert all([tuple(s) for s in got[1000 + i].spans] == [(15, 75)] for i in range(25))


@pytest.mark.parametrize("held", [fuzzy_passages.HELD, 8])
def test_matches_in_parts_are_those_of_the_whole(monkeypatch, held):
    monkeypatch.setattr(fuzzy_passages, "HELD", held)
    rng = np.random.default_rng(0)
    rows = sorted({(int(rng.integers(0, 3)), int(rng.integers(0, 40)), int(rng.integers(0, 50))) for _ in range(400)})
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + 7])], ["seed", "k", "at"]) for i in range(0, len(rows), 7)]
    met = [r for b in fuzzy_passages._matches(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns))]
    hub = {s: min(k for t, k, _ in rows if t == s) for s in range(3)}
    assert {(a, b, x, s) for a, b, x, y, s in met if s is not None} == {(k, hub[s], at, s) for s, k, at in rows if k != hub[s]}
    assert {(a, x) for a, b, x, y, s in met if s is None} == {(k, at) for s, k, at in rows if k != hub[s]}


@pytest.mark.parametrize("block", [fuzzy_passages.BLOCK, 16])
def test_fuzzy_passages_of_a_large_key_beside_its_hub(spark, monkeypatch, block):
    """Five passages of 50 words in two texts each, and the first and the last 49 words of each in twenty others: all keys are large, and few hubs are alike."""
    monkeypatch.setattr(fuzzy_passages, "BLOCK", block)
    number, rows = iter(range(100_000)), []
    fresh = lambda n: [f"u{next(number)}" for _ in range(n)]
    for i in range(5):
        passage = fresh(50)
        rows += [(2 * i + s, " ".join(fresh(20 + s) + passage + fresh(25))) for s in (0, 1)]
        rows += [(100 + 40 * i + 20 * p + n, " ".join(fresh(5 + n) + passage[p : p + 49] + fresh(9))) for p in (0, 1) for n in range(20)]
    got = fuzzy(spark, rows)
    assert set(got) == set(range(10))
    assert {tuple(sorted((i, p))) for i, r in got.items() for p in r.partners} == {(2 * i, 2 * i + 1) for i in range(5)}


@pytest.mark.parametrize("blocks", [1, 2])
def test_places_of_a_large_key_meet_through_one_text(blocks):
    """Runs of one word of 45 to 84 in 40 texts: those of 50 or more are alike, and each two of them are linked, or linked with one other, by far fewer links than pairs."""
    number = iter(range(100_000))
    fresh = lambda n: [f"u{next(number)}" for _ in range(n)]
    texts = [" ".join(fresh(20 + i) + ["the"] * (45 + i) + fresh(70)) for i in range(40)]
    wanted = [[20 + i, 36 + i, 52 + i] for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(texts), pa.array(wanted)], ["k", "text", "wanted"])
    around = pa.Table.from_batches(list(fuzzy_passages._surroundings([batch])))
    own = [k % blocks for k in around["k"].to_pylist()]
    links = set()
    for a in range(blocks):
        for b in range(a, blocks):
            rows = around.filter(pa.array([o in (a, b) for o in own]))
            n = len(rows)
            side = pa.array([o for o in own if o in (a, b)], pa.int32())
            table = pa.table({"pair": pa.array([7] * n), "k": rows["k"], "x": rows["x"], "open": pa.array([1] * n, pa.int32()), "own": side, "one": pa.array([int(a == b)] * n, pa.int32()), "words": rows["words"]})
            for got in fuzzy_passages._blocks(table.to_batches()):
                links |= {tuple(sorted(x)) for x in zip(got["k"].to_pylist(), got["other"].to_pylist(), strict=True)}
                for k, s, e in zip(*(got[c].to_pylist() for c in ("k", "s", "e")), strict=True):
                    assert 20 + k <= s < e <= 65 + 2 * k
    near = {i: {j for link in links if i in link for j in link} for i in range(40)}
    assert all(not near[i] for i in range(5))
    assert all(near[i] & near[j] for i in range(5, 40) for j in range(i + 1, 40))
    assert len(links) < 200


def test_fuzzy_places_of_a_seed_all_meet():
    """400 products of places of one seed in two texts, and some hundred thousand, each once; parts end with a place of the first text."""
    from swelter.llm import fuzzy_passages as fp

    for n, m in ((20, 20), (700, 300)):
        k = np.repeat([1, 2], [m, n])
        parts = [(p, q) for p, q, _ in fp._paired(np.zeros(n + m, np.int64), k, ())]
        p, q = (np.concatenate(x) for x in zip(*parts, strict=True))
        assert len(set(zip(p.tolist(), q.tolist(), strict=True))) == len(p) == n * m and set(k[p]) == {2} and set(k[q]) == {1}
        assert all(a[-1] != b[0] for (a, _), (b, _) in zip(parts, parts[1:], strict=False))
