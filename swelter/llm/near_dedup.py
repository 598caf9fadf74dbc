"""Near-duplicate detection: MinHash signatures joined by a multi-index Hamming join, confirmed on whole shingle sets.

1. Documents with equal shingle sets are one class; only classes go on.
2. A signature has ``CHUNKS`` chunks of ``CHUNK`` 16-bit symbols. Each chunk gives a key for every choice of ``ERRORS`` positions
   left out, so any two signatures that differ in fewer than ``CHUNKS * (ERRORS + 1)`` symbols share a key. (At a similarity of
   exactly 0.8 a pair shares no key once in 40,000.)
3. Buckets of up to ``SMALL`` classes give their pairs. A larger one gives the pairs with its smallest class, and its members
   are kept for step 5, so its pairs are never all made.
4. Pairs are confirmed on the whole sets of 64-bit shingle hashes, and links are joined to components.
5. Members of a large bucket that are not yet in its commonest component are compared with all of that component's members in
   large buckets and with each other, on whole sets, block by block of about ``BLOCK_BYTES`` on either side; pairs are never
   listed. So no link between components is lost.

Null, empty and wordless texts have no shingles and are linked with nothing. A component is named by the smallest doc_id of its
documents; null ids come last. Repeated rows each get a row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swelter.llm.common import durable, mixed, parallelism, small_batches, text_buffer
from swelter.llm.components import components
from swelter.llm.minhash import SHINGLE, block_keys, shingle_sets, signature

SIMILARITY, SMALL, BLOCK_BYTES = (4, 5), 48, 8 << 20


def _summary(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, one, two, sigs = [], [], [], []
        for s in shingle_sets(*text_buffer(b.column(2)), size):
            n.append(len(s))
            one.append(int(mixed(s).sum() ^ np.uint64(len(s))) if len(s) else 0)
            two.append(int(mixed(s ^ np.uint64(0x6A09E667F3BCC909)).sum()) if len(s) else 0)
            sigs.append(signature(s).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int32()), pa.array(np.array(one, np.uint64).view(np.int64)), pa.array(np.array(two, np.uint64).view(np.int64)), pa.array(sigs, pa.binary())], ["doc_id", "k", "n", "cid", "check", "sig"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 2000):
            c = b.slice(i, 2000)
            keys = block_keys(np.stack([np.frombuffer(x.as_buffer(), np.uint16) for x in c.column(2)]))
            each = keys.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(c.column(0).to_numpy(), each)), pa.array(np.repeat(c.column(1).to_numpy(), each))], ["key", "cid", "n"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (key null) and members of large buckets (b is the smallest class) from rows sorted by key and class.

    A run of equal keys is held up to SMALL rows; beyond that only its first class is kept."""
    num, den = SIMILARITY
    out: list[tuple] = []
    run_key, run, large = None, [], False

    def near(a, b):
        return den * min(a[1], b[1]) >= num * max(a[1], b[1])

    def close():
        if not large:
            out.extend((None, run[i][0], run[j][0]) for i in range(len(run)) for j in range(i) if near(run[i], run[j]))

    def flush():
        columns = zip(*out, strict=True)
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "a", "b"])
        out.clear()
        return batch

    for b in batches:
        keys, ids, sizes = (c.to_numpy() for c in b.columns)
        same = np.zeros(len(keys), bool)
        same[1:] = keys[1:] == keys[:-1]
        if len(keys):
            same[0] = run_key == keys[0]
        busy = same.copy()
        busy[:-1] |= same[1:]
        if len(keys):
            busy[-1] = busy[0] = True  # a run may go on into the next batch
        for r in np.flatnonzero(busy):
            if keys[r] != run_key:
                close()
                run_key, run, large = keys[r], [], False
            me = (int(ids[r]), int(sizes[r]))
            if large:
                out.append((int(run_key), me[0], run[0][0]))
                if near(me, run[0]):
                    out.append((None, me[0], run[0][0]))
            else:
                run.append(me)
                if len(run) > SMALL:
                    for x in run:
                        out.append((int(run_key), x[0], run[0][0]))
                        if x is not run[0] and near(x, run[0]):
                            out.append((None, x[0], run[0][0]))
                    run, large = run[:1], True
            if len(out) >= 50_000:
                yield flush()
    close()
    if out:
        yield flush()


def _blobs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in shingle_sets(*text_buffer(b.column(1)), size)], pa.binary())], ["cid", "set"])


def _opened(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.uint64)


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        common, last, kept = [], None, None
        for x, y in zip(b.column(2), b.column(3), strict=True):
            y = y.as_py()
            if y != last:
                last, kept = y, _opened(y)
            both = np.sort(np.concatenate([_opened(x.as_py()), kept]), kind="stable")
            common.append(int((both[1:] == both[:-1]).sum()))
        total = [(len(x.as_py()) + len(y.as_py())) // 8 for x, y in zip(b.column(2), b.column(3), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(common, pa.int64()), pa.array(np.array(total, np.int64) - np.array(common, np.int64))], ["a", "b", "common", "together"])


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


class NearDuplicates:
    """The steps above over one table; ``result`` has a row per document row."""

    def __init__(self, docs: DataFrame, size: int = SHINGLE):
        self.size = size
        self.texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("k"), "text")
        self.rows = durable(self.texts.mapInArrow(lambda it: _summary(it, size), "doc_id long, k long, n int, cid long, check long, sig binary"))
        named = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "k", "sig")
        self.classes = durable(self.rows.where("n > 0").groupBy("cid", "check", "n").agg(F.min(named).alias("m")).select("cid", "n", "m.doc_id", "m.k", "m.sig"))

    def candidates(self) -> tuple[DataFrame, DataFrame]:
        """Pairs (a, b) of classes, and members (key, a, b) of large buckets with their smallest class b."""
        keys = self.classes.select("cid", "n", "sig").mapInArrow(_keys, "key long, cid long, n int")
        width = max(parallelism(keys.sparkSession), self.classes.rdd.getNumPartitions())
        found = durable(keys.repartition(width, "key").sortWithinPartitions("key", "cid").mapInArrow(_pairs, "key long, a long, b long"))
        return found.where("key is null").select("a", "b").distinct(), found.where("key is not null")

    def sets(self, wanted: DataFrame) -> DataFrame:
        """The shingle set of one text of each wanted class (cid)."""
        sources = self.classes.join(wanted, "cid", "left_semi").select("cid", F.col("doc_id").alias("d"), F.col("k").alias("kk"))
        found = self.texts.join(sources, (F.col("k") == F.col("kk")) & F.col("doc_id").eqNullSafe(F.col("d"))).select("cid", "text")
        size = self.size
        return durable(found.mapInArrow(lambda it: _blobs(it, size), "cid long, set binary").dropDuplicates(["cid"]))

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are linked, on whole sets."""
        pairs = durable(pairs)
        sets = self.sets(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct())
        whole = pairs.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("cid").alias("b"), F.col("set").alias("y")), "b")
        num, den = SIMILARITY
        seen = whole.select("a", "b", "x", "y").mapInArrow(_overlap, "a long, b long, common long, together long")
        return durable(seen.where(F.expr(f"{den} * common >= {num} * together")).select("a", "b"))

    def placed(self) -> DataFrame:
        """doc_id, k (the hash of the text), n_shingles, component_id, kept for every document row."""
        pairs, members = self.candidates()
        links = self.links(pairs)
        roots = components(links)
        if members.take(1):
            roots = components(links.union(self._rest(members, roots)))
        node = self.classes.select("cid", "doc_id").join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
        first = node.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        named = node.join(first, "root").select(F.col("cid").alias("c"), "component_id")
        out = self.rows.select("doc_id", "k", "n", "cid").join(named, (F.col("cid") == F.col("c")) & (F.col("n") > 0), "left")
        component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        return out.select("doc_id", "k", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))

    def result(self) -> DataFrame:
        return self.placed().drop("k")

    def first_texts(self) -> DataFrame:
        """doc_id and k of one text of each component: that of the smallest doc_id, then of the smallest k. Null ids take no part."""
        rows = self.placed().where("doc_id is not null")
        return rows.groupBy("component_id", F.col("n_shingles") > 0).agg(F.min(F.struct("doc_id", "k")).alias("m")).select("m.*")

    def _rest(self, members: DataFrame, roots: DataFrame) -> DataFrame:
        """Step 5: links between the components that meet in large buckets, one at least for each class and component."""
        at = members.select("key", "a").join(roots.withColumnRenamed("node", "a"), "a", "left").withColumn("root", F.coalesce("root", "a"))
        home = at.groupBy("key", "root").agg(F.count("*").alias("c")).groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("home"))
        at = durable(at.join(home, "key").select("home", "a", "root").distinct())
        asked = at.where("root <> home")
        held = at.join(asked.select("home").distinct(), "home", "left_semi")
        sets = self.sets(held.select(F.col("a").alias("cid")).distinct())
        size = sets.select(F.col("cid").alias("a"), F.octet_length("set").alias("size"))
        held, asked = held.join(size, "a"), asked.join(size, "a")
        count = lambda df, name: df.groupBy("home").agg(F.ceil(F.sum("size") / BLOCK_BYTES).cast("int").alias(name))
        blocks = durable(count(held, "own").join(count(asked, "others"), "home"))
        # every block of held sets meets every block of asked ones, so neither side of a task grows with the bucket
        deal = lambda c: F.pmod(F.xxhash64("a"), F.col(c)).cast("int")
        each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        held = held.join(blocks, "home").withColumns({"block": deal("own"), "part": each("others")}).join(sets.withColumnRenamed("cid", "a"), "a")
        asked = asked.join(blocks, "home").withColumns({"block": each("own"), "part": deal("others")}).join(sets.withColumnRenamed("cid", "a"), "a")
        columns = ["home", "block", "part", "a", "root", "set"]
        asked = asked.select(*(F.col(c).alias(f"asked_{c}") for c in columns))
        both = held.select(*columns).groupBy("home", "block", "part").cogroup(asked.groupBy("asked_home", "asked_block", "asked_part"))
        return durable(both.applyInArrow(_met, "a long, b long"))


def _met(held: pa.Table, asked: pa.Table) -> pa.Table:
    """For each asked set, one linked held set of every other component."""
    num, den = SIMILARITY
    ids, roots = held["a"].to_numpy(), held["root"].to_numpy()
    sets = [_opened(x) for x in held["set"].to_pylist()]
    sizes = np.array([len(x) for x in sets], np.int64)
    shingles, owner = np.concatenate([*sets, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(shingles, kind="stable")
    shingles, owner = shingles[order], owner[order]
    out: list[tuple[int, int]] = []
    for a, root, blob in zip(*(asked[f"asked_{c}"].to_pylist() for c in ("a", "root", "set")), strict=True):
        x = _opened(blob)
        low, high = np.searchsorted(shingles, x), np.searchsorted(shingles, x, "right")
        n = high - low
        hits = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(owner[hits], minlength=len(sets))
        linked = np.flatnonzero((den * common >= num * (sizes + len(x) - common)) & (roots != root))
        _, first = np.unique(roots[linked], return_index=True)
        out += [(max(a, int(b)), min(a, int(b))) for b in ids[linked[first]]]
    return pa.table([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document row."""
    return NearDuplicates(docs).result()
