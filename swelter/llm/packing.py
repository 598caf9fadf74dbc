"""Best-fit packing of tokenised documents into sequences of a fixed length, by hierarchical residual packing.

Every partition packs its own pieces best-fit decreasing. Sequences that are at least ``NEARLY`` full are final; the others
become items of their own size, are brought together ``FAN_IN`` partitions at a time, and are packed again, until one
partition is left, or a round over more partitions than the session shuffles to saves under a hundredth. A task holds about
``HELD`` pieces (a few numbers each) at a time.

A document is its token ids and the end id. Longer ones are cut into whole sequences, with the remainder first. Null and
empty texts are one piece, the end id alone. Repeated documents are packed each; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swelter.llm.common import durable, parallelism, small_batches, text_buffer

LENGTH, END_ID, NEARLY, FAN_IN, HELD = 1024, 2, 0.998, 8, 200_000

PIECE = "struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>"
BIN_SCHEMA = f"sequence_id long, filled long, final boolean, pieces array<{PIECE}>"


class Encoder:
    """Token ids of the vocabulary file, equal to those of the tokenizers library.

    The same vocabulary and merges run several times faster in tiktoken, so texts that hold no special token go there (the
    tests compare both libraries over all of Unicode); the rest is encoded by tokenizers itself.
    """

    def __init__(self, path: str, ranks: str | None = None):
        from tokenizers import Tokenizer

        self.exact, self.fast, self.specials = Tokenizer.from_file(path), None, ()
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
            self.specials = tuple(t.content.encode() for t in self.exact.get_added_tokens_decoder().values())

    def __call__(self, text: bytes) -> np.ndarray:
        if self.fast and not any(s in text for s in self.specials):
            return np.array(self.fast.encode_ordinary(text.decode()), "<u4")
        return np.array(self.exact.encode(text.decode(), add_special_tokens=False).ids, "<u4")


def cut(n: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """Start and length of each piece of n tokens; only the first may be shorter than a sequence."""
    first = n if n <= length else n % length or length
    return [(0, first), *((s, length) for s in range(first, n, length))]


def best_fit(sizes: list[int], length: int = LENGTH) -> list[list[int]]:
    """Bins of item numbers: largest items first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}  # room left -> bins
    rooms: list[int] = []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        at = bisect_left(rooms, sizes[k])
        if at == len(rooms):
            bins.append([k])
            b, room = len(bins) - 1, length - sizes[k]
        else:
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
            bins[b].append(k)
            room -= sizes[k]
        if room:
            if room not in by_room:
                insort(rooms, room)
                by_room[room] = []
            by_room[room].append(b)
    return bins


def _packed(groups: list[tuple[int, list[tuple]]], ids: Iterator[int], length: int, nearly: float) -> pa.RecordBatch:
    """Bins of groups of pieces; a group that comes as an item stays together."""
    rows = []
    for members in best_fit([size for size, _ in groups], length):
        at, pieces = 0, []
        for k in members:
            size, own = groups[k]
            pieces += [(*p[:5], at + p[5]) for p in own]
            at += size
        rows.append((next(ids), at, at >= nearly * length, pieces))
    piece = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("offset", pa.int64())])
    flat = [p for r in rows for p in r[3]]
    values = pa.StructArray.from_arrays([pa.array([p[k] for p in flat], piece.field(k).type) for k in range(6)], fields=list(piece))
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(r[3]) for r in rows)]), pa.int32()), values)
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.bool_()), lists], ["sequence_id", "filled", "final", "pieces"])


def _numbers(level: int) -> Iterator[int]:
    """Sequence numbers that no other task or level uses."""
    at = (level << 56) | (TaskContext.get().partitionId() << 32)
    while True:
        yield at
        at += 1


def pack(docs: DataFrame, vocabulary: str, ranks: str | None = None, *, length: int = LENGTH, end_id: int = END_ID, nearly: float = NEARLY, fan_in: int = FAN_IN) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, ids, held = Encoder(vocabulary, ranks), _numbers(0), []
        for b in batches:
            data, offsets = text_buffer(b.column(1))
            for r, doc in enumerate(b.column(0).to_pylist()):
                tokens = np.append(encode(data[offsets[r] : offsets[r + 1]].tobytes()), np.uint32(end_id)).astype("<u4")
                for k, (s, n) in enumerate(cut(len(tokens), length)):
                    held.append((n, [(doc, k, s, n, zlib.crc32(tokens[s : s + n].tobytes()), 0)]))
                if len(held) >= HELD:
                    yield _packed(held, ids, length, nearly)
                    held = []
        if held:
            yield _packed(held, ids, length, nearly)

    bins = durable(small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(first, BIN_SCHEMA))
    done, level, width = [bins.where("final")], 0, bins.rdd.getNumPartitions()
    rest = bins.where("not final")
    before = rest.count()
    while before and width > 1:
        level, width = level + 1, -(-width // fan_in)

        def again(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            ids, held, some = _numbers(level), [], 0
            for b in batches:
                for size, pieces in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                    held.append((size, [tuple(p.values()) for p in pieces]))
                    some += len(pieces)
                if some >= HELD:
                    yield _packed(held, ids, length, nearly)
                    held, some = [], 0
            if held:
                yield _packed(held, ids, length, nearly)

        bins = durable(rest.repartition(width).mapInArrow(again, BIN_SCHEMA))
        done.append(bins.where("final"))
        rest = bins.where("not final")
        after = rest.count()
        if after >= 0.99 * before and width > parallelism(docs.sparkSession):
            break
        before = after
    done.append(rest)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("sequence_id", F.explode("pieces").alias("p")).select("p.doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32", "sequence_id", "p.offset")
