"""Merkle manifest of a dataset: a hash tree over the rows of each language and over the languages, with a proof per row.

Sibling-shift self-joins: a level is a table of nodes with their places. Each node finds its sibling by an equi-join of the level
with itself on the computed place (XOR 1 for a binary tree; with a wider ``arity`` one join for each other slot), and the rows of
slot zero emit the parents. Proofs come down the same way: each level joins the level above on the parent's place. A node's row
holds 32-byte digests; texts are read once, for the leaves.

Places come from ranges of the order (language, doc_id, leaf): each range numbers its own rows and moves them up by the rows before
it, so that a language with a third of all rows lies in many tasks. Levels are written to the shared folder, so a lost executor
costs one level at most. A level of at most ``SMALL`` nodes lies in one partition and is joined there; a table of at most ``SMALL``
languages is broadcast.

A leaf is the hash of doc_id, source, lang, n_chars and text, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself.
Rows with the same doc_id follow one another by their leaf; equal rows have equal leaves, and which of them comes first shows only
in their proofs. A null doc_id comes first, a null language before the others. Of an empty table nothing is returned. Extra columns
are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swelter.llm.common import durable, shared_folder

#: Nodes (of about 100 bytes, or 2 kB where they carry a proof) that lie in one partition; languages up to which their table is broadcast.
SMALL = 8192
#: Rows of a task that numbers or joins nodes.
TASK_ROWS = 250_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(columns: dict[str, Column]) -> Column:
    """The 32 bytes of a row's hash."""
    parts = []
    for name in FIELDS:
        text = columns[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return _digest(F.concat(*parts))


def ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """The frame, cut from its lineage, with its place ``i`` (from 0) in the order, nulls first; no task sorts more than a range of it."""
    rows = df.count()
    at = [F.asc_nulls_first(c) for c in order]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, part = 0, TaskContext.get().partitionId()
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(done, done + n))], [*b.schema.names, "_p", "_k"])
            done += n

    dealt = durable(df.repartitionByRange(max(1, -(-rows // TASK_ROWS)), *at).sortWithinPartitions(*at).mapInArrow(number, f"{kinds}, _p int, _k long"))
    counts = dealt.groupBy("_p").agg(F.count("*").alias("n"))  # a row per range
    before = counts.select("_p", (F.sum("n").over(Window.orderBy("_p")) - F.col("n")).alias("before"))
    return dealt.join(F.broadcast(before), "_p").select(*df.columns, (F.col("_k") + F.col("before")).alias("i"))


def written(df: DataFrame, one: bool) -> DataFrame:
    """The frame as a table in the shared folder, of one partition if ``one``. A checkpoint would carry along what Spark knows of all levels before it."""
    path = os.path.join(shared_folder(df.sparkSession), f"manifest-{uuid.uuid4().hex}")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return table.coalesce(1) if one else table


class Tree:
    """All levels of the trees of nodes (g, j, c, h): tree, place in it, nodes of it at this level, digest; further columns stay.

    ``heights`` are the levels at which trees end. ``levels`` holds a table per level with ``s``: a byte that says how many siblings
    stand left of the node, and their digests from left to right. ``roots`` has (g, h)."""

    def __init__(self, nodes: DataFrame, rows: int, widest: int, trees: int, heights: set[int], arity: int = 2):
        self.arity, self.heights, self.levels, self.sizes = arity, heights, [], []
        done = []
        while True:
            level = written(self._with_siblings(nodes) if widest > 1 else nodes.withColumn("s", F.lit(b"\0")), rows <= SMALL)
            self.levels.append(level)
            self.sizes.append(rows)
            if len(self.levels) - 1 in heights:
                done.append(level.where("c = 1").select("g", "h"))
            if widest <= 1:
                break
            first = level.where((F.col("c") > 1) & (F.col("j") % arity == 0))
            parent = _digest(F.concat(_hex(F.col("h")), _hex(F.substring("s", 2, 1 << 30))))
            nodes = first.select("g", F.floor(F.col("j") / arity).alias("j"), F.ceil(F.col("c") / arity).alias("c"), parent.alias("h"))
            widest = -(-widest // arity)
            rows = rows // arity + trees
            if rows <= SMALL:
                nodes = nodes.coalesce(1)  # tables of one partition are joined where they lie
        self.roots = done[0]
        for more in done[1:]:
            self.roots = self.roots.unionByName(more)

    def _with_siblings(self, nodes: DataFrame) -> DataFrame:
        """One equi-join for each other slot; a place beyond the last node of a tree finds nothing."""
        out, slot = nodes, F.col("j") % self.arity
        others = range(1, self.arity)
        for k in others:
            place = F.col("j").bitwiseXOR(F.lit(1)) if self.arity == 2 else F.col("j") - slot + (slot + k) % self.arity
            found = nodes.select("g", place.alias("j"), F.col("h").alias(f"_s{k}"), slot.alias(f"_at{k}"))
            out = out.join(found.hint("merge"), ["g", "j"], "left")
        at = lambda t: F.coalesce(*(F.when(F.col(f"_at{k}") == t, F.col(f"_s{k}")) for k in others), F.lit(b""))
        out = out.withColumn("s", F.concat(F.unhex(F.lpad(F.hex(slot), 2, "0")), *(at(t) for t in range(self.arity))))
        return out.drop(*(f"_{n}{k}" for k in others for n in ("s", "at")))

    def paths(self, above: DataFrame, trees: int) -> DataFrame:
        """Each node of the lowest level with its ``path``, the siblings (as in ``levels``) of the nodes from it up to the root of its tree,
        and on from there by ``above`` (g, path, further columns)."""
        carried = ["path", *(c for c in above.columns if c not in ("g", "path"))]
        tops = above.select("g", F.lit(-1).cast("long").alias("up"), *carried)
        out, below = None, 0
        for k in reversed(range(len(self.levels))):
            up = tops if k in self.heights else None
            if out is not None:
                higher = written(out.select("g", F.col("j").alias("up"), *carried), below <= SMALL)
                up = higher if up is None else up.unionByName(higher)
            if below + trees <= SMALL:
                up = up.coalesce(1)
            here = F.when(F.col("c") == 1, F.lit(-1).cast("long")).otherwise(F.floor(F.col("j") / self.arity))
            joined = self.levels[k].withColumn("up", here).join(up.hint("merge"), ["g", "up"])
            own = F.when(F.col("c") > 1, F.array("s")).otherwise(F.array().cast("array<binary>"))
            out = joined.withColumn("path", F.concat(own, "path")).drop("up", "s")
            below = self.sizes[k]
        return out


def height(c: Column, arity: int) -> Column:
    """Levels above the leaves of a tree with c of them."""
    return F.size(F.filter(F.array(*(F.lit(arity**k) for k in range(63) if arity**k < 1 << 62)), lambda x: x < c))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""

    def step(h: Column, x: Column) -> Column:
        left = 32 * F.conv(F.hex(F.substring(x, 1, 1)), 16, 10).cast("int")
        return _digest(F.concat(_hex(F.substring(x, F.lit(2), left)), _hex(h), _hex(F.substring(x, left + 2, F.lit(1 << 30)))))

    return F.aggregate(path, leaf, step)


def tampered_row() -> Column:
    """Rows whose n_chars is raised by one to show that their proof fails: every seventh by the crc32 of the decimal doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))


def manifest(docs: DataFrame, *, arity: int = 2) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    if not 2 <= arity <= 255:
        raise ValueError("a node has 2 to 255 children")
    columns = {c: F.col(c) for c in FIELDS}
    changed = columns | {"n_chars": F.col("n_chars") + 1}
    leaves = docs.select("doc_id", "lang", leaf_digest(columns).alias("h"), F.when(tampered_row(), leaf_digest(changed)).alias("t"), F.monotonically_increasing_id().alias("r"))
    placed = durable(ranked(durable(leaves), ["lang", "doc_id", "h", "r"]))
    langs = durable(placed.groupBy("lang").agg(F.min("i").alias("first"), F.count("*").alias("c")))
    size = langs.agg(F.count("*"), F.max("c"), F.sum("c")).first()
    trees, widest, rows = size[0], size[1] or 0, size[2] or 0
    if not rows:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    ends = {r[0] for r in langs.select(height(F.col("c"), arity)).distinct().collect()}  # 63 at most
    # the first place of a language orders the languages as their names do
    groups = durable(ranked(langs, ["first"]).select("lang", "first", "c", F.col("i").alias("g")))
    named = groups.withColumnRenamed("lang", "_lang")
    named = F.broadcast(named) if trees <= SMALL else named
    nodes = placed.join(named, F.col("lang").eqNullSafe(F.col("_lang"))).select("doc_id", "t", "g", (F.col("i") - F.col("first")).alias("j"), "c", "h")
    tree = Tree(nodes, rows, widest, trees, ends, arity)
    top = Tree(tree.roots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("j"), F.lit(trees).cast("long").alias("c"), "h"), trees, trees, 1, {sum(arity**k < trees for k in range(63))}, arity)
    root = top.roots.select("g", F.array().cast("array<binary>").alias("path"), F.col("h").alias("root"))
    tops = durable(top.paths(root, 1).select(F.col("j").alias("g"), "path", "root", F.col("h").alias("subroot")))
    out = tree.paths(tops, trees)
    proof = F.sha2(F.array_join(F.transform("path", lambda x: _hex(F.substring(x, 2, 1 << 30))), ""), 256)
    out = out.withColumn("f", folded(F.coalesce("t", "h"), F.col("path")))
    return out.select("doc_id", _hex(F.col("h")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"), proof.alias("proof_sha256"), _hex(F.col("f")).alias("folded_root"), (F.col("f") == F.col("root")).alias("verified"))
