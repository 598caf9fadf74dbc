"""Benchmark decontamination by winnowing.

Of every ``WINDOW`` consecutive words of a benchmark item, the smallest hash of its ``GRAM``-word grams is kept as a
fingerprint; a document keeps the same minima, so every shared span of ``WINDOW`` words shares at least one
fingerprint. Fingerprints of documents are joined with those of the items, and each hit is extended to all windows
around it, which are confirmed on 64-bit hashes of the whole window. An item with fewer words is one window of its own
length and is looked up at every word.

Up to ``BROADCAST_BYTES`` of benchmark text, the item index is broadcast and documents are read once, with no shuffle.
Beyond that the fingerprints are joined by a shuffle, on distinct texts.

Null and empty texts have no words; items without an id or words take no part; repeated item ids are one item;
repeated documents each get their row; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swelter.llm.common import PLAIN_WORDS, Words, durable, in_sorted, selected, slices, small_batches, text_buffer, text_key

WINDOW, GRAM = 10, 5
BROADCAST_BYTES = 32 << 20


class ItemIndex:
    """Windows of the items by length, as sorted hashes with the items of each, and the fingerprints of full windows."""

    def __init__(self, items: list[tuple[object, str]], window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram = window, gram
        self.ids = sorted({str(i) for i, t in items if i is not None and t})
        place = {x: k for k, x in enumerate(self.ids)}
        items = [(i, t) for i, t in items if i is not None and t]
        data, offsets = text_buffer(pa.array([t for _, t in items], pa.string()))
        w = Words(data, offsets, PLAIN_WORDS)
        owner = np.repeat(np.array([place[str(i)] for i, _ in items], np.int64), w.counts) if items else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(items)), w.counts)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in range(1, window + 1):
            h = w.grams(n)
            at = np.flatnonzero(h != np.uint64(0xFFFFFFFFFFFFFFFF))
            if n < window:
                at = at[(w.counts[row[at]] == n)]
            if len(at):
                pairs = np.unique(np.rec.fromarrays([h[at], owner[at]], names="h,i"))
                keys, start = np.unique(pairs.h, return_index=True)
                self.by_length[n] = keys, np.append(start, len(pairs)), pairs.i.copy()
        g = w.grams(gram)
        self.fingerprints = np.unique(g[selected(g, window - gram + 1)])


def windows(w: Words, index: ItemIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and place in by_length's hashes of every window of the index that the texts hold."""
    starts, lengths, keys = [], [], []
    for n, (table, _, _) in index.by_length.items():
        h = w.grams(n)
        if n == index.window:
            g = w.grams(index.gram)
            at = selected(g, index.window - index.gram + 1)
            at = at[in_sorted(g[at], index.fingerprints) >= 0]
            near = np.unique((at[:, None] - np.arange(index.window - index.gram + 1)).ravel())
            near = near[near >= 0]
        else:
            near = np.arange(len(h))
        k = in_sorted(h[near], table)
        near, k = near[k >= 0], k[k >= 0]
        starts.append(near), lengths.append(np.full(len(near), n)), keys.append(k)
    if not starts:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(starts), np.concatenate(lengths), np.concatenate(keys)


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any span."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change)[:n] > 0


def decontaminate_text(data: np.ndarray, offsets: np.ndarray, index: ItemIndex) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Words, hit words and item ids (as strings) of each text."""
    n_words, n_hit, found = [], [], []
    for i, j in slices(offsets):
        w = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], PLAIN_WORDS)
        s, n, k = windows(w, index)
        hit = np.concatenate([[0], np.cumsum(covered(s, n, len(w.hashes)))])
        names: list[list[str]] = [[]] * (j - i)
        rows = np.searchsorted(w.first, s, "right") - 1
        for r in np.unique(rows):
            own = set()
            for length, key in set(zip(n[rows == r].tolist(), k[rows == r].tolist(), strict=True)):
                _, start, items = index.by_length[length]
                own.update(items[start[key] : start[key + 1]].tolist())
            names[r] = [index.ids[x] for x in own]
        n_words.append(w.counts), n_hit.append(hit[w.first[1:]] - hit[w.first[:-1]])
        found += names
    none = [np.zeros(0, np.int64)]
    return np.concatenate(n_words or none), np.concatenate(n_hit or none), found


_FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string()))])
_FOUND_SQL = "struct<n_words:long,n_hit:long,items:array<string>>"


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, columns: tuple[str, ...] = (), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and ``columns`` of the input."""
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(F.col(c).alias(f"_{c}") for c in columns))
    found = _found(docs, benchmark, broadcast_bytes)
    hit, items = F.coalesce("found.n_hit", F.lit(0).cast("long")), F.coalesce("found.items", F.array().cast("array<string>"))
    digest = F.sha2(F.array_join(F.array_sort(items), ","), 256)
    return found.select("doc_id", F.col("found.n_words").alias("n_words"), hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), digest.alias("items_sha256"), (hit > 0).alias("contaminated"), *(F.col(f"_{c}").alias(c) for c in columns))


def _found(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int) -> DataFrame:
    """The documents with ``found``: words, hit words and items of each."""
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null and text <> ''")
    if (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > broadcast_bytes:
        return _by_shuffle(docs, items)
    index = docs.sparkSession.sparkContext.broadcast(ItemIndex([tuple(r) for r in items.collect()]))  # of a checked size

    @F.arrow_udf(_FOUND_SQL)
    def search(text: pa.Array) -> pa.Array:
        n_words, n_hit, names = decontaminate_text(*text_buffer(text), index.value)
        return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(names, pa.list_(pa.string()))], fields=list(_FOUND))

    return docs.withColumn("found", search("text"))


def _by_shuffle(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The same for a benchmark of any size: fingerprints and windows meet in equi-joins, documents by the key of their text."""
    span = WINDOW - GRAM + 1

    def item_rows(batches):
        for b in batches:
            ids = b.column(0).cast(pa.string()).to_pylist()
            data, offsets = text_buffer(b.column(1))
            for r, name in enumerate(ids):
                one = ItemIndex([(name, bytes(data[offsets[r] : offsets[r + 1]]).decode())])
                for n, (keys, _, _) in one.by_length.items():
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array([n] * len(keys), pa.int32()), pa.array(keys.view(np.int64))], ["item", "n", "h"])
                prints = one.fingerprints if WINDOW in one.by_length else one.fingerprints[:0]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(prints), pa.string()), pa.array([0] * len(prints), pa.int32()), pa.array(prints.view(np.int64))], ["item", "n", "h"])

    rows = durable(items.mapInArrow(item_rows, "item string, n int, h long"))
    lengths = [r[0] for r in rows.where(f"n between 1 and {WINDOW - 1}").select("n").distinct().collect()]  # nine at most
    keyed = docs.withColumns(dict(zip(("k1", "k2"), text_key(F.col("text")), strict=True)))

    def prints(batches):
        for b in batches:
            data, offsets = text_buffer(b.column(2))
            for i, j in slices(offsets):
                w = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], PLAIN_WORDS)
                g = w.grams(GRAM)
                at = selected(g, span)
                found = [(at, g[at], 0)] + [(x := np.flatnonzero((h := w.grams(n)) != np.uint64(0xFFFFFFFFFFFFFFFF)), h[x], n) for n in lengths]
                for at, h, n in found:
                    row = np.searchsorted(w.first, at, "right") - 1 + i
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(np.full(len(at), n, np.int32)), pa.array(h.view(np.int64)), pa.array((at - w.first[row - i]).astype(np.int64))], ["k1", "k2", "n", "h", "at"])

    texts = keyed.select("k1", "k2", "text").dropDuplicates(["k1", "k2"])
    seen = texts.mapInArrow(prints, "k1 long, k2 long, n int, h long, at long")
    meet = seen.join(rows.select("n", "h").distinct(), ["n", "h"], "left_semi")
    near = meet.groupBy("k1", "k2").agg(F.collect_list(F.struct("n", "at")).alias("near"))

    def extend(batches):
        for b in batches:
            data, offsets = text_buffer(b.column(2))
            for r, near in enumerate(b.column(3).to_pylist()):
                w = Words(data[offsets[r] : offsets[r + 1]], np.array([0, offsets[r + 1] - offsets[r]]), PLAIN_WORDS)
                for n in {x["n"] for x in near}:
                    at = np.array([x["at"] for x in near if x["n"] == n])
                    at = np.unique(at if n else (at[:, None] - np.arange(span)).ravel())
                    at = at[at >= 0]
                    h = w.grams(n or WINDOW)[at]
                    size = len(at)
                    yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[r].as_py()] * size, pa.int64()), pa.array([b.column(1)[r].as_py()] * size, pa.int64()), pa.array([n or WINDOW] * size, pa.int32()), pa.array(h.view(np.int64)), pa.array(at.astype(np.int64))], ["k1", "k2", "n", "h", "at"])

    spans = texts.join(near, ["k1", "k2"]).mapInArrow(extend, "k1 long, k2 long, n int, h long, at long")
    hits = spans.join(rows.where("n > 0"), ["n", "h"]).groupBy("k1", "k2").agg(F.collect_set(F.struct("at", "n")).alias("spans"), F.sort_array(F.collect_set("item")).alias("items"))

    @F.arrow_udf(_FOUND_SQL)
    def count(text: pa.Array, spans: pa.Array, names: pa.Array) -> pa.Array:
        data, offsets = text_buffer(text)
        n_words = np.concatenate([Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], PLAIN_WORDS).counts for i, j in slices(offsets)] or [np.zeros(0, np.int64)])
        n_hit = []
        for n, own in zip(n_words.tolist(), spans.to_pylist(), strict=True):
            own = own or []
            n_hit.append(int(covered(np.array([x["at"] for x in own], np.int64), np.array([x["n"] for x in own], np.int64), n).sum()))
        return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), names.cast(pa.list_(pa.string()))], fields=list(_FOUND))

    return keyed.join(hits, ["k1", "k2"], "left").withColumn("found", count("text", "spans", "items"))
