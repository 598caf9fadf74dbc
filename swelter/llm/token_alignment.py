"""Alignment of two tokenizers over the same bytes, and how often their ids are linked in a corpus.

Diagonal run skipping: the ends of both token sequences are byte offsets. Where token i of the one and token i + shift of the other
end alike, the following ones mostly do too, so stretches of one-to-one tokens are jumped by probes of doubling length, each one
comparison of two slices of the end arrays; the last probe is halved to the first difference. What differs is resolved locally, by
advancing the side that is behind until both end at one offset; this gives a group of several tokens and a new shift.

Before that, texts are cut at every space between two characters that are no white space. Neither vocabulary has a token across such
a place (see :func:`cut`), so the ids of a part do not depend on its text, and each worker encodes a part that it has met only once.

Links are counted in two steps, none of which gathers a pair's rows: every block of texts counts its pairs, sums are added up by
pair, and each block gets the sums of its own pairs back. Blocks hold ``BLOCK_BYTES`` of text (one longer text makes a block of its
own). A pair's count is the number of rows that hold it linked, so repeated rows count each.

Null and empty texts have no tokens, nor has a text whose tokens do not give its bytes again (one with U+2581, for instance).
Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swelter.llm.common import durable, small_batches, text_buffer

#: Bytes of text whose pairs are counted together; a first probe's tokens.
BLOCK_BYTES, PROBE = 8 << 20, 2
#: Ids of the second vocabulary lie below 2**15 and those of the first below 2**16, so a pair is a positive 32-bit number.
SHIFT = 15
#: Characters of a part and of all parts that a worker keeps the ids of; when they are full, it starts anew.
PART, KEPT = 40, 6 << 20

ALIGNED = "doc_id long, block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


class Side:
    """A vocabulary as what alignment needs: ids of a text, and the bytes of an id."""

    def __init__(self, encode, pieces: list[bytes], parted: bool = True):
        self.encode, self.pieces, self.parted = encode, pieces, parted
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.table = np.array(pieces, object)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.sizes[ids])

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(self.table[ids].tolist())


def byte_level(ranks: str) -> Side:
    """The byte-level vocabulary, with the text's own special strings as plain text; it is given a leading space."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    pieces = [b""] * (max(table.values()) + 1)
    for piece, k in table.items():
        pieces[k] = piece
    return Side(lambda text: encoding.encode_ordinary(" " + text), pieces)


def sentence_pieces(model: str) -> Side:
    """The sentencepiece vocabulary, which adds the leading space itself; U+2581 stands for a space and <0xHH> for a byte."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    if processor.vocab_size() > 1 << SHIFT:
        raise ValueError(f"the second vocabulary may have {1 << SHIFT} ids")
    pieces, parted = [], _merges_only(processor)
    for k in range(processor.vocab_size()):
        piece = processor.id_to_piece(k)
        parted &= "▁" not in piece.lstrip("▁")
        pieces.append(bytes([int(piece[3:5], 16)]) if processor.is_byte(k) else piece.replace("▁", " ").encode())
    return Side(lambda text: processor.encode(text), pieces, parted)


def _merges_only(processor) -> bool:
    """Whether the model joins neighbours by pieces alone (BPE), and changes no text before it does."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(processor.serialized_model_proto())
    rules, trained = model.normalizer_spec, model.trainer_spec
    plain = not (rules.precompiled_charsmap or rules.remove_extra_whitespaces) and rules.add_dummy_prefix and rules.escape_whitespaces
    usual = {model.SentencePiece.NORMAL, model.SentencePiece.BYTE, model.SentencePiece.CONTROL, model.SentencePiece.UNKNOWN}
    return plain and trained.model_type == trained.BPE and not trained.treat_whitespace_as_suffix and all(p.type in usual for p in model.pieces)


#: Python's white space holds all that the byte-level pattern takes for it.
_CUT = re.compile(r"(?<=\S) (?=\S)")


def cut(text: str) -> list[str]:
    """The parts of a text; a space and a part in turn are the text with a space ahead.

    The byte-level pattern never goes on over a space that follows something else: only a pre-token of white space holds one inside,
    and a single one before something else opens the next pre-token or is one. In pieces a space stands for U+2581, which stands
    first in them only, so no merge crosses it from the left."""
    return _CUT.split(text)


class Encoder:
    """The ids of texts on both sides. Parts that are not known yet are encoded together, in one call for each text and side."""

    def __init__(self, a: Side, b: Side):
        self.sides = (a, b)
        self.parted = a.parted and b.parted
        self.clear()

    def clear(self) -> None:
        self.known: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.held = 0

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """None where the tokens of a side do not give the text again."""
        parts = cut(text) if self.parted else [text]
        first, second = self.known
        new = [p for p in dict.fromkeys(parts) if p not in first]
        if self.held > KEPT:
            self.clear()
            first, second = self.known
            new = list(dict.fromkeys(parts))
        if new:
            raw = [b" " + p.encode() for p in new]
            whole, ends = b"".join(raw), np.cumsum([len(x) for x in raw])
            for side, known in zip(self.sides, self.known, strict=True):
                ids = np.array(side.encode(" ".join(new)), np.int32)
                if side.joined(ids) != whole:
                    for k in self.known:
                        for p in new:
                            k.pop(p, None)
                    return None
                upto = [0, *(np.searchsorted(side.ends(ids), ends, "right") * 4).tolist()]
                flat = ids.tobytes()
                known.update((p, flat[s:e]) for p, s, e in zip(new, upto, upto[1:], strict=False))
        out = tuple(np.frombuffer(b"".join(map(known.__getitem__, parts)), np.int32) for known in self.known)
        for p in new:
            if len(p) > PART:
                del first[p], second[p]
            else:
                self.held += len(p) + 1
        return out


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index behind the last token of each group, in both sequences, which end at the same offset.

    One-to-one stretches come as runs of groups of one token each."""
    n, m = len(ends_a), len(ends_b)
    raw_a, raw_b = ends_a.astype("<i8").tobytes(), ends_b.astype("<i8").tobytes()
    at_a, at_b = memoryview(raw_a).cast("q"), memoryview(raw_b).cast("q")
    first, second, lengths = [], [], []  # a run of groups that end at first + 1, ..., first + length
    i = j = 0
    while i < n and j < m:
        run, probe, most = 0, PROBE, min(n - i, m - j)
        while run < most:
            k = min(probe, most - run)
            x, y = 8 * (i + run), 8 * (j + run)
            if raw_a[x : x + 8 * k] == raw_b[y : y + 8 * k]:
                run, probe = run + k, probe * 2
                continue
            while k > 1:  # the first difference lies among k tokens
                half = k // 2
                if raw_a[x : x + 8 * half] == raw_b[y : y + 8 * half]:
                    run, x, y, k = run + half, x + 8 * half, y + 8 * half, k - half
                else:
                    k = half
            break
        if run:
            first.append(i)
            second.append(j)
            lengths.append(run)
            i, j = i + run, j + run
        if i >= n or j >= m:
            break
        a, b = at_a[i], at_b[j]
        while a != b:
            if a < b:
                i += 1
                a = at_a[i]
            else:
                j += 1
                b = at_b[j]
        first.append(i)
        second.append(j)
        lengths.append(1)
        i, j = i + 1, j + 1
    lengths = np.array(lengths, np.int64)
    step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + 1
    return np.repeat(np.array(first, np.int64), lengths) + step, np.repeat(np.array(second, np.int64), lengths) + step


def links(ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray) -> np.ndarray:
    """The pair code of every two tokens that share bytes: a group of p and q tokens has p + q - 1, one for each stretch between its ends."""
    size_a, size_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
    plain = (size_a == 1) & (size_b == 1)
    one = (ids_a[upto_a[plain] - 1].astype(np.int64) << SHIFT) | ids_b[upto_b[plain] - 1]
    in_a, in_b = np.repeat(~plain, size_a), np.repeat(~plain, size_b)
    odd_a, odd_b, own_a, own_b = ends_a[in_a], ends_b[in_b], ids_a[in_a], ids_b[in_b]
    ends = np.union1d(odd_a, odd_b)
    many = (own_a[np.searchsorted(odd_a, ends)].astype(np.int64) << SHIFT) | own_b[np.searchsorted(odd_b, ends)]
    return np.concatenate([one, many])


class Written:
    """Groups as text, from tables of the written ids."""

    def __init__(self, n_a: int, n_b: int):
        self.tables = [np.array([f"{k}{end}" for k in range(n)], object) for n, end in ((n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";"))]

    def __call__(self, ids_a: np.ndarray, ids_b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray) -> str:
        out = np.empty(len(ids_a) + len(ids_b), object)
        size_a, size_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        at_a = np.arange(len(ids_a)) + np.repeat(upto_b - size_b, size_a)
        at_b = np.arange(len(ids_b)) + np.repeat(upto_a, size_b)
        for ids, at, upto, (inner, last) in ((ids_a, at_a, upto_a, self.tables[:2]), (ids_b, at_b, upto_b, self.tables[2:])):
            out[at] = inner[ids]
            out[at[upto - 1]] = last[ids[upto - 1]]
        return "".join(out.tolist())[:-1]


def packed_links(codes: np.ndarray) -> bytes:
    """The distinct codes, as differences, and how often each stands; most numbers are small, so they compress well."""
    pairs, times = np.unique(codes, return_counts=True)
    return zlib.compress(np.concatenate([np.diff(pairs, prepend=0), times]).astype("<u4").tobytes(), 1)


def unpacked_links(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64)
    half = len(numbers) // 2
    return np.cumsum(numbers[:half]), numbers[half:]


@functools.lru_cache(maxsize=1)
def _loaded(ranks: str, model: str) -> tuple[Encoder, Written]:
    """What a worker keeps from one task to the next."""
    a, b = byte_level(ranks), sentence_pieces(model)
    return Encoder(a, b), Written(len(a.pieces), len(b.pieces))


def aligned(docs: DataFrame, ranks: str, model: str, *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per document: its tokens, groups and links, and the block whose pairs are counted together."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, write = _loaded(ranks, model)
        block, held = TaskContext.get().partitionId() << 32, 0
        nothing = (0, 0, 0, 0, "", None)
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            rows, blocks = [], []
            for r in range(batch.num_rows):
                raw = data[offsets[r] : offsets[r + 1]].tobytes()
                if held and held + len(raw) > block_bytes:
                    block, held = block + 1, 0
                held += len(raw)
                blocks.append(block)
                rows.append(_one(raw, encode, write) if raw else nothing)
            columns = [pa.array([x[k] for x in rows], kind) for k, kind in enumerate((*[pa.int64()] * 4, pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blocks, pa.int64()), *columns], ["doc_id", "block", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    def _one(raw: bytes, encode: Encoder, write: Written) -> tuple:
        if (ids := encode(raw.decode())) is None:
            return (0, 0, 0, 0, "", None)
        ids_a, ids_b = ids
        a, b = encode.sides
        ends_a, ends_b = a.ends(ids_a), b.ends(ids_b)
        upto_a, upto_b = groups(ends_a, ends_b)
        codes = links(ids_a, ids_b, ends_a, ends_b, upto_a, upto_b)
        digest = hashlib.sha256(write(ids_a, ids_b, upto_a, upto_b).encode()).hexdigest()
        return (len(ids_a), len(ids_b), len(upto_a), len(codes), digest, packed_links(codes))

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(align, ALIGNED)


def _pairs_of_blocks(rows: DataFrame) -> DataFrame:
    """(block, pair, n): in how many documents of the block the pair is linked."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}

        def total(block: int) -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(held.pop(block)), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), block)), pa.array(pairs.astype(np.int32)), pa.array(n)], ["block", "pair", "n"])

        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if block not in held and held:  # a block's rows lie together
                    yield total(next(iter(held)))
                held.setdefault(block, []).append(unpacked_links(data)[0])
        for block in list(held):
            yield total(block)

    return rows.where("links is not null").select("block", "links").mapInArrow(count, "block long, pair int, n long")


def alignment(docs: DataFrame, ranks: str, model: str, *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = durable(aligned(docs, ranks, model, block_bytes=block_bytes))
    asked = durable(_pairs_of_blocks(rows))
    sums = asked.groupBy("pair").agg(F.sum("n").alias("total"))
    # an id of the first vocabulary has at most as many pairs as the second has ids
    best = F.max("total").over(Window.partitionBy(F.shiftright("pair", SHIFT)))
    known = sums.select("pair", "total", (F.col("total") == best).alias("best"))
    answers = asked.select("block", "pair").join(known, "pair")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("pair")
        pairs, total, best = (right.column(c).to_numpy() for c in ("pair", "total", "best"))
        n_best, sums = [], []
        for chunk in left.column("links").chunks:
            for data in chunk:
                if not data.is_valid:
                    n_best.append(0)
                    sums.append(0)
                    continue
                own, times = unpacked_links(data.as_py())
                at = np.searchsorted(pairs, own)
                n_best.append(int(times[best[at]].sum()))
                sums.append(int((total[at] * times).sum()))
        kept = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64())).append_column("groups_sha256", left.column("groups_sha256"))

    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
