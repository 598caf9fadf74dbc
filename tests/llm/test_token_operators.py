"""Operators on tokens and the manifest, against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from texts import SCHEMA, corpus, frame, words

from swelter.llm import manifest, token_alignment, token_counts
from swelter.llm.oracles import MERKLE
from swelter.llm.queries import tokenizer_files

AWKWARD = ["it's  the\n\n end ", "<|endoftext|> in <|endoftext|>text", " leading", "tabs\t\tand   wide", "▁ literal", "﻿mark", "日本語のテキスト and 한국어 mixed", "🙂🙃 👩‍👩‍👧 ok", "<0x41> <s> </s> [INST]", "áé combining", "1234567890 3.14", "    code():\n        return x"]

# --- manifest


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc, text, lang, source, n = row
    n = None if n is None else n + more
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def grown(nodes: list[str], arity: int) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + arity]) for k in range(0, len(levels[-1]), arity)])
    return levels


def siblings(levels, j, arity):
    """What stands left and right of the node's path at each level."""
    out = []
    for level in levels[:-1]:
        first = j // arity * arity
        out.append((level[first:j], level[j + 1 : first + arity]))
        j //= arity
    return out


def manifest_expected(rows, arity):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = [grown([leaf(r) for r in sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))], arity) for x in langs]
    top = grown([t[-1][0] for t in trees], arity)
    out = []
    for g, x in enumerate(langs):
        own = sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        for j, r in enumerate(own):
            path = siblings(trees[g], j, arity) + siblings(top, g, arity)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf(r, int(changed))
            for left, right in path:
                node = h(*left, node, *right)
            proof = h(*(s for left, right in path for s in (*left, *right)))
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows():
    rng = random.Random(1)
    rows = [(k, words(rng, 5), rng.choice(["en", "de", "fr", "Ä", ""]), "s", k) for k in range(70)]
    rows += [(r[0], r[1], r[2], r[3], None) for r in rows[:20]] + rows[30:40] + [(7, None, None, None, None), (None, "x", "en", None, 3), (None, None, None, None, None), (900, "", "once", "s", 0), (901, "ü" * 9, "en", "", -1)]
    return rows


def documents(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, g int, j string, h int, `_p` int, path string"
    return spark.createDataFrame([(*r, 1, "x", 2, 3, "y") for r in rows], schema)


@pytest.mark.parametrize(("arity", "small", "task"), [(2, manifest.SMALL, manifest.TASK_ROWS), (2, 0, 40), (3, 0, 40)])
def test_manifest(spark, monkeypatch, arity, small, task):
    """Also with every level joined by a shuffle, from several ranges."""
    monkeypatch.setattr(manifest, "SMALL", small)
    monkeypatch.setattr(manifest, "TASK_ROWS", task)
    rows = manifest_rows()
    got = sorted((tuple(r) for r in manifest.manifest(documents(spark, rows), arity=arity).collect()), key=str)
    assert got == manifest_expected(rows, arity)
    assert not all(r[6] for r in got) and any(r[6] for r in got)


def test_manifest_of_few_rows(spark):
    for rows in ([], [(1, "a", "en", "s", 1)], [(14, "a", "en", "s", 1), (2, "b", None, "s", 1)]):
        got = sorted((tuple(r) for r in manifest.manifest(documents(spark, rows)).collect()), key=str)
        assert got == manifest_expected(rows, 2)


def test_manifest_sql_equals_brute_force():
    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar, lang varchar, source varchar, n_chars bigint)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", rows := manifest_rows())
    assert sorted(con.sql(MERKLE).fetchall(), key=str) == manifest_expected(rows, 2)


# --- token counts


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_files()[0])


def long_texts():
    rng = random.Random(3)
    mixed = "".join(rng.choice(AWKWARD) + rng.choice([" ", "", "\n"]) for _ in range(400))
    runs = [words(rng, 50) + run + words(rng, 50) for run in ("a" * 5000, " " * 4000, "\n" * 3000, "漢" * 2500, "<|endoftext|>" * 300, "<|endo", "!?" * 2000, "'re" * 900)]
    return [mixed, *runs, words(rng, 4000), "é" * 999, "<|endoftext|>" * 2]


@pytest.mark.parametrize(("chunk", "overlap"), [(token_counts.CHUNK, token_counts.OVERLAP), (700, 160), (997, 211)])
def test_token_counts(spark, tokenizer, chunk, overlap):
    """Also with chunks so short that runs without a boundary force wider ones."""
    rows = corpus() + [(300 + k, t) for k, t in enumerate(AWKWARD)] + [(400 + k, t) for k, t in enumerate(long_texts())]
    rows += [(400, long_texts()[0]), (400, long_texts()[1]), (None, long_texts()[1]), (None, long_texts()[1])]
    got = token_counts.token_counts(frame(spark, rows), *tokenizer_files(), chunk=chunk, overlap=overlap).collect()
    count = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    want = [(i, len((t or "").encode()), count(t), count(t) > 512) for i, t in rows]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_every_cut_of_a_text_gives_the_same_count(spark, tokenizer):
    """Cuts at every place of an awkward text, special tokens and characters of several bytes among them."""
    text = "".join(AWKWARD) * 4
    frames = [token_counts.token_counts(spark.createDataFrame([(k, "x" * k + " " + text) for k in range(0, 120)], "doc_id long, text string"), *tokenizer_files(), chunk=400, overlap=130)]
    got = {r.doc_id: r.n_tokens for f in frames for r in f.collect()}
    assert got == {k: len(tokenizer.encode("x" * k + " " + text, add_special_tokens=False).ids) for k in range(0, 120)}


def test_token_counts_of_nothing(spark):
    assert token_counts.token_counts(spark.createDataFrame([], SCHEMA), *tokenizer_files()).collect() == []


def test_token_counts_reject_other_vocabularies(spark):
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        token_counts.token_counts(spark.createDataFrame([], SCHEMA), public_tokenizers.path("word_bpe_49k.json"))


# --- alignment


def plain_groups(ends_a, ends_b):
    common = sorted(set(ends_a) & set(ends_b))
    return [ends_a.index(c) + 1 for c in common], [ends_b.index(c) + 1 for c in common]


def test_groups_equal_common_ends():
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 10, 60, 300):
        for share in (0.05, 0.5, 0.9, 1.0):
            ends = sorted(rng.sample(range(1, 2 * n + 1), n)) if n else []
            a, b = ([e for e in ends[:-1] if rng.random() < share] + ends[-1:] for _ in range(2))
            got = token_alignment.groups(np.array(a, np.int64), np.array(b, np.int64))
            assert tuple(x.tolist() for x in got) == plain_groups(a, b)


def alignment_files():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


def alignment_expected(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment_files()[1])
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(c): c for c in kept} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in kept)}
    docs, counts = [], collections.Counter()
    for doc, text in rows:
        pairs = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a = [bytes(shown[c] for c in a.id_to_token(i)) for i in ids_a]
            bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
        if not text or not (b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode()):
            docs.append((doc, [], [], [], ""))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in xs]).tolist() for xs in (bytes_a, bytes_b))
        for i, x in zip(ids_a, range(len(ids_a))):
            for k, y in zip(ids_b, range(len(ids_b))):
                if max(ends_a[x] - len(bytes_a[x]), ends_b[y] - len(bytes_b[y])) < min(ends_a[x], ends_b[y]):
                    pairs.append((i, k))
        upto_a, upto_b = plain_groups(ends_a, ends_b)
        spans = zip([0, *upto_a], upto_a, [0, *upto_b], upto_b)
        text = ";".join(",".join(map(str, ids_a[p:q])) + "|" + ",".join(map(str, ids_b[r:s])) for p, q, r, s in spans)
        docs.append((doc, ids_a, ids_b, pairs, text))
        counts.update(set(pairs))
    highest = collections.defaultdict(int)
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    return [(doc, len(x), len(y), t.count(";") + 1 if t else 0, len(p), sum(counts[q] == highest[q[0]] for q in p), sum(counts[q] for q in p), hashlib.sha256(t.encode()).hexdigest() if t else "") for doc, x, y, p, t in docs]


@pytest.mark.parametrize("block", [token_alignment.BLOCK_BYTES, 600])
def test_alignment(spark, block):
    """Also with a few texts to a block, and blocks of texts without tokens."""
    rows = [(i, t if t is None else t[:1500]) for i, t in corpus()] + [(300 + k, t) for k, t in enumerate(AWKWARD)] + [(300, AWKWARD[0])] + [(k, None) for k in range(500, 520)]
    got = token_alignment.alignment(frame(spark, rows), *alignment_files(), block_bytes=block)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(alignment_expected(rows), key=str)


def test_alignment_of_nothing(spark):
    assert token_alignment.alignment(spark.createDataFrame([], SCHEMA), *alignment_files()).collect() == []


def test_alignment_of_a_long_text(spark):
    """Runs of one character, and a text of a megabyte: every group's bytes are equal on both sides, and links follow from groups."""
    rng = random.Random(9)
    rows = [(1, "a" * 60000), (2, " " * 30000), (3, words(rng, 180_000))]
    got = {r.doc_id: r for r in token_alignment.alignment(frame(spark, rows), *alignment_files()).collect()}
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups and r.n_groups for r in got.values())


def test_alignment_encodes_a_part_once(monkeypatch):
    """Ids of parts are those of whole texts, whatever white space, and whether the parts are known, too long to keep, or dropped."""
    rng = random.Random(11)
    a, b = token_alignment.byte_level(alignment_files()[0]), token_alignment.sentence_pieces(alignment_files()[1])
    sizes, side = [], a.encode
    encode = token_alignment.Encoder(token_alignment.Side(lambda t: sizes.append(len(t)) or side(t), a.pieces), b)
    monkeypatch.setattr(token_alignment, "KEPT", 2000)
    pieces = [" ", "  ", "\n", "\t", "\u3000", "\xa0", "\x1c", "\x85", "'s", "'", "don't", "the", "1234", "...", "<s>", "</s>", "\u2581", "\u00e9", "\u65e5\u672c", "\U0001f600", "\0", "x" * 60]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12)))
        got = encode(text)
        want = [np.array(s(text), np.int32) for s in (side, b.encode)]
        if a.joined(want[0]) == b.joined(want[1]) == b" " + text.encode():
            assert all(np.array_equal(x, y) for x, y in zip(got, want, strict=True))
        else:
            assert got is None
    encode.clear()
    sizes.clear()
    encode("one two three " * 1000)
    encode("three two one two " * 1000)
    assert encode.parted and sum(sizes) < 60
