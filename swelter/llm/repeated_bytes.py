"""Exact removal of long repeated byte strings, with run-length indexes over the text that can repeat.

A window is a string of ``LENGTH`` bytes. Its anchor is the smallest hash of its ``GRAM``-byte grams, so equal windows have equal
anchors wherever they stand. A context is a maximal run of windows of one text with one anchor.

1. Every context is listed with its anchor and a 64-bit hash of its bytes (a row for about 180 bytes of text).
2. A context that stands twice repeats wholly. Anchors with different contexts, or twice inside one, may hold repeats; all others
   hold none. Contexts are counted per anchor, in one shuffle. Anchors with more than one in ``HOT`` of all rows are counted with
   partial sums instead, and their rows are matched with broadcast keys where they stay; both ways give the same rows.
3. The bytes of one copy of each context in question are fetched from its text and dealt out by anchor. Blocks of about
   ``BLOCK`` bytes get a run-length index (a run-compressed Burrows-Wheeler transform with sampled run ends), from which matching
   statistics stream; the places that match for ``LENGTH`` bytes or more are marked.
4. An anchor with more than ``LARGE`` bytes of contexts takes the exact way that has no bound: a 64-bit hash of each of its
   windows, counted with partial sums. Repeated rows count as often as they stand, which is what is asked.
5. Marks are gathered per text and cut out of every document that has it.

Texts are UTF-8 bytes; null and empty ones are kept as they are. Texts shorter than ``LENGTH`` lose nothing. Repeated rows are
documents of their own, so they repeat each other. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swelter.llm.common import byte_sums, durable, parallelism, selected, slices, small_batches, span_hashes, text_buffer, text_key, window_minima
from swelter.llm.run_index import RunIndex

LENGTH, GRAM, BLOCK, LARGE = 400, 32, 1 << 17, 900_000
#: An anchor with more than one in ``HOT`` of all context rows is added up before it is shuffled.
HOT = 1000
_PLACE = ("doc_id", "k1", "k2", "start", "size")


def contexts(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Row, anchor, hash, first byte, size and whether the anchor stands twice, of every context of a slice of texts."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 6
    sums = byte_sums(data)
    starts = np.arange(len(data) - gram + 1)
    grams = span_hashes(sums, starts, starts + gram) >> np.uint64(1)
    low = window_minima(grams, length - gram + 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = (np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data)))[: len(low)] >= length
    row = row[: len(low)]
    new = np.ones(len(low) + 1, bool)
    new[1:-1] = (low[1:] != low[:-1]) | (row[1:] != row[:-1]) | ~whole[:-1]
    first = np.flatnonzero(new[:-1] & whole)
    last = np.flatnonzero((new[1:] | np.append(~whole[1:], True)) & whole)
    anchor, end = low[first], last + length
    at = selected(grams, length - gram + 1)
    values, which = np.unique(np.concatenate([anchor, grams[at]]), return_inverse=True)
    span = len(data) + 1
    places = np.sort(which[len(first) :] * span + at)
    twice = np.searchsorted(places, which[: len(first)] * span + end - gram, "right") - np.searchsorted(places, which[: len(first)] * span + first) > 1
    return row[first], anchor, span_hashes(sums, first, end), first - offsets[row[first]], end - first, twice


def _listed(batches: Iterator[pa.RecordBatch], length: int = LENGTH, gram: int = GRAM) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = text_buffer(b.column(3))
        for i, j in slices(offsets):
            row, anchor, bytes_hash, start, size, twice = contexts(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], length, gram)
            if len(row):
                own = pa.array(row + i)
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(own) for k in range(3)), pa.array(anchor.astype(np.int64)), pa.array(bytes_hash.astype(np.uint64).view(np.int64)), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(twice.astype(bool))], ["doc_id", "k1", "k2", "anchor", "hash", "start", "size", "twice"])


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts wanted of each text."""
    for b in batches:
        data, offsets = text_buffer(b.column(2))
        out: list[tuple] = []
        for r, wanted in enumerate(b.column(3).to_pylist()):
            k1, k2 = b.column(0)[r].as_py(), b.column(1)[r].as_py()
            for w in wanted:
                s = offsets[r] + w["start"]
                out.append((k1, k2, w["anchor"], w["start"], w["large"], data[s : s + w["size"]].tobytes()))
                if len(out) >= 5000:
                    yield _rows(out)
                    out = []
        if out:
            yield _rows(out)


_FETCHED = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("anchor", pa.int64()), ("start", pa.int32()), ("large", pa.bool_()), ("bytes", pa.binary())])
_MARK = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])


def _rows(out: list[tuple], schema: pa.Schema = _FETCHED) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _runs(places: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """Spans of bytes that windows at the given starts cover; windows that touch are one span."""
    if len(places):
        cuts = np.flatnonzero(np.diff(places) > length)
        for a, b in zip(np.append(places[:1], places[cuts + 1]), np.append(places[cuts], places[-1:]), strict=True):
            yield int(a), int(b) + length


def _indexed(batches: Iterator[pa.RecordBatch], length: int = LENGTH) -> Iterator[pa.RecordBatch]:
    """Marks from rows sorted by anchor; whole anchors share a block."""
    block: list[tuple] = []
    group: list[tuple] = []
    size = group_size = 0

    def marks(rows):
        out = []
        for (_, k1, k2, start, _), places in zip(rows, RunIndex([r[4] for r in rows]).repeated(length), strict=True):
            out += [(k1, k2, start + a, start + b) for a, b in _runs(places, length)]
        return _rows(out, _MARK) if out else None

    def rows():
        for b in batches:
            yield from zip(*(b.column(k).to_pylist() for k in (2, 0, 1, 3, 5)), strict=True)

    for row in rows():
        if group and group[0][0] != row[0]:
            if block and size + group_size > BLOCK:
                if done := marks(block):
                    yield done
                block, size = [], 0
            block, size, group, group_size = block + group, size + group_size, [], 0
        group.append(row)
        group_size += len(row[4]) + 1
    if block and size + group_size > BLOCK:
        if done := marks(block):
            yield done
        block = []
    if (block or group) and (done := marks(block + group)):
        yield done


def _windows(batches: Iterator[pa.RecordBatch], length: int = LENGTH) -> Iterator[pa.RecordBatch]:
    """The hash of every window of the contexts."""
    for b in batches:
        k1, k2, starts = (b.column(k).to_pylist() for k in (0, 1, 3))
        for r, text in enumerate(b.column(5).to_pylist()):
            x = np.frombuffer(text, np.uint8)
            at = np.arange(len(x) - length + 1)
            h = span_hashes(byte_sums(x), at, at + length)
            n = len(at)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, k1[r])), pa.array(np.full(n, k2[r])), pa.array(at + starts[r]), pa.array(h.view(np.int64))], ["k1", "k2", "at", "h"])


def _cut(batches: Iterator[pa.RecordBatch], carried: tuple[str, ...] = (), keep: bool = False) -> Iterator[pa.RecordBatch]:
    """The results, with the text that is left if it is to be kept, and the columns of the batch from the fourth on."""
    for b in batches:
        data, offsets = text_buffer(b.column(1))
        out = []
        marks = b.column(2)
        for r, doc in enumerate(b.column(0).to_pylist()):
            x = data[offsets[r] : offsets[r + 1]]
            if marks[r].is_valid:
                change = np.zeros(len(x) + 1, np.int64)
                np.add.at(change, marks[r].values.field("s").to_numpy(), 1)
                np.add.at(change, marks[r].values.field("e").to_numpy(), -1)
                gone = np.cumsum(change)[:-1] > 0
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                kept = x[~gone].tobytes()
            else:
                spans, kept = 0, x.tobytes()
            out.append((doc, len(x), len(x) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore") if keep else None))
        columns = list(zip(*out, strict=True)) or [()] * 6
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip(columns, types, strict=True)), *b.columns[3:]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", *carried])


def _usual(rows: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Contexts that stand twice, and one copy of each whose anchor is in question; anchors with few rows each."""
    anchor, context = Window.partitionBy("anchor"), Window.partitionBy("anchor", "hash")
    counted = rows.repartition(max(width, rows.rdd.getNumPartitions()), "anchor").select(
        *rows.columns,
        F.count(F.lit(1)).over(context).alias("n"),
        (F.row_number().over(context.orderBy("doc_id", "k1", "k2", "start")) == 1).alias("one"),
        ((F.min("hash").over(anchor) != F.max("hash").over(anchor)) | F.max("twice").over(anchor)).alias("asked"),
        (F.sum("size").over(anchor) > LARGE).alias("large"),
    )
    counted = durable(counted.where("n > 1 or asked"))
    return counted.where("n > 1").select(*_PLACE), counted.where("asked and one").select(*_PLACE, "anchor", "large")


def _again(rows: DataFrame, counts: DataFrame, keys: list[str], least: float) -> DataFrame:
    """The rows whose key stands more than once (``n``); those of keys with more than ``least`` rows, fewer than ``HOT`` keys, are not shuffled."""
    many = rows.join(F.broadcast(counts.where((F.col("n") > 1) & (F.col("n") > least))), keys, "left_semi")
    return many.union(rows.join(counts.where((F.col("n") > 1) & (F.col("n") <= least)), keys, "left_semi"))


def _hot(rows: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """The same for fewer than ``HOT`` anchors with many rows, which are added up before any shuffle; no task gets all rows of one."""
    contexts = durable(rows.groupBy("anchor", "hash").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*_PLACE)).alias("one"), F.max("twice").alias("twice"), F.sum("size").alias("bytes")))
    anchors = contexts.groupBy("anchor").agg(((F.count(F.lit(1)) > 1) | F.max("twice")).alias("asked"), (F.sum("bytes") > LARGE).alias("large"))
    wanted = contexts.join(F.broadcast(anchors.where("asked")), "anchor").select("one.*", "anchor", "large")
    return _again(rows, contexts, ["anchor", "hash"], least).select(*_PLACE), wanted


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """k1, k2 (the key of a text) and the spans (s, e) of bytes that repeat, gathered per text."""
    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(F.col("text")), "text")
    width = parallelism(docs.sparkSession)
    rows = texts.mapInArrow(lambda it: _listed(it, length, gram), "doc_id long, k1 long, k2 long, anchor long, hash long, start int, size int, twice boolean")
    rows = durable(rows)
    least = rows.count() / HOT
    hot = durable(rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least).select("anchor", F.lit(True).alias("hot")))
    marked = rows.join(F.broadcast(hot), "anchor", "left")
    wholly, wanted = (a.unionByName(b) for a, b in zip(_usual(marked.where("hot is null").drop("hot"), width), _hot(marked.where("hot").drop("hot"), least), strict=True))
    wholly = wholly.select("k1", "k2", F.col("start").cast("long").alias("s"), (F.col("start").cast("long") + F.col("size")).alias("e")).distinct()
    wanted = wanted.groupBy("doc_id", "k1", "k2").agg(F.collect_list(F.struct("anchor", "start", "size", "large")).alias("wanted"))
    wanted = wanted.select(F.col("doc_id").alias("d"), F.col("k1").alias("w1"), F.col("k2").alias("w2"), "wanted")
    same = (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")) & F.col("doc_id").eqNullSafe(F.col("d"))
    found = texts.join(wanted, same).select("k1", "k2", "text", "wanted").mapInArrow(_fetched, "k1 long, k2 long, anchor long, start int, large boolean, bytes binary")
    found = durable(found)
    dealt = found.where("not large").repartition(max(width, found.rdd.getNumPartitions()), "anchor").sortWithinPartitions("anchor")
    indexed = dealt.mapInArrow(lambda it: _indexed(it, length), "k1 long, k2 long, s long, e long")
    hashed = durable(found.where("large").mapInArrow(lambda it: _windows(it, length), "k1 long, k2 long, at long, h long"))
    windows = durable(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    again = _again(hashed, windows, ["h"], hashed.count() / HOT)
    # windows that start in one stretch of ``length`` bytes overlap, so together they cover one span
    again = again.groupBy("k1", "k2", F.expr(f"at div {length}")).agg(F.min("at").alias("s"), (F.max("at") + length).alias("e")).select("k1", "k2", "s", "e")
    marks = wholly.union(indexed).union(again)
    return marks.groupBy("k1", "k2").agg(F.collect_set(F.struct("s", "e")).alias("marks"))


def _joined(docs: DataFrame, columns: tuple[str, ...], length: int = LENGTH) -> DataFrame:
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *text_key(F.col("text")), *columns)
    return keyed.join(repeats(docs, length), ["k1", "k2"], "left")


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"


def remove_repeats(docs: DataFrame, *, columns: tuple[str, ...] = (), length: int = LENGTH) -> DataFrame:
    """Without every string of ``length`` bytes that stands twice: doc_id, n_bytes, n_removed, n_spans, kept_sha256, the text that is left, and ``columns`` of the input.

    A character of which some bytes are removed goes whole."""
    rows = _joined(docs, columns, length).select("doc_id", "text", "marks", *columns)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(lambda it: _cut(it, columns, True), _OUT + "".join(f", `{c}` {types[c]}" for c in columns))


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document row."""
    return _joined(docs, ()).select("doc_id", "text", "marks").mapInArrow(lambda it: _cut(it), _OUT).drop("text")
