"""Approximate nearest neighbours with a hash-prefix forest.

Every vector has one long hash string per tree: the signs of its products with ``BITS`` random directions. A shard of the
vectors keeps, for each tree, the sorted array of its strings. A query descends each tree to its longest-prefix matches by
binary search, then climbs all trees together, one bit at a time, until the prefixes it stands on hold at least
``SHARE`` of the shard; the vectors under them, and no others, are ranked by their exact distance. The best of every shard are merged.

Shards have about ``SHARD_ROWS`` vectors and are built once; the stated query set streams past each in batches, so neither a hot
vector nor a large table makes a task larger. ``SHARE`` is what isotropic 64-dimensional data needs for a recall above 0.9 in
shards of a few hundred to eight thousand vectors; data with structure reaches it with less. Every query meets every shard, so
the work grows with queries times vectors.

Vectors that are null, all zero, or hold a null or non-finite number take no part, nor do rows without an id or vectors of
another dimension than most; exact repeats of a row count once. Unequal vectors of one id are none of each other's neighbours;
as queries they give one list together. Fewer candidates than asked for are all returned. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swelter.llm.common import parallelism

TREES, BITS, SHARE, SHARD_ROWS, NEAREST = 24, 32, 0.6, 8192, 10
#: Queries ranked at a time.
QUERY_ROWS = 256


def matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


class Forest:
    """Sorted hash strings of one shard, a row per tree."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.bits, self.planes = bits, rng.standard_normal((trees, vectors.shape[1], bits))
        strings = self.strings(vectors)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, 1)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        weight = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        return np.stack([((vectors @ p) > 0) @ weight for p in self.planes])

    def candidates(self, query: np.ndarray, least: int) -> np.ndarray:
        """Vectors under the deepest prefixes, the same depth in all trees, that hold at least ``least`` distinct vectors."""
        shift = np.arange(self.bits + 1, dtype=np.uint64)  # bits given up, from the longest prefix to the empty one
        low = (query[:, None] >> shift) << shift
        high = low | ((np.uint64(1) << shift) - np.uint64(1))
        first = np.stack([np.searchsorted(s, a) for s, a in zip(self.sorted, low, strict=True)])
        last = np.stack([np.searchsorted(s, b, "right") for s, b in zip(self.sorted, high, strict=True)])
        found = np.zeros(self.order.shape[1], bool)
        for k in range(int(np.argmax((last - first).sum(0) >= least)), self.bits + 1):
            for o, a, b in zip(self.order, first[:, k], last[:, k], strict=True):
                found[o[a:b]] = True
            if np.count_nonzero(found) >= least:
                break
        return np.flatnonzero(found)


def usable(vectors: DataFrame) -> DataFrame:
    """id and v (array of doubles) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    return rows.dropDuplicates(["id", "v"])


def _nearest(forest: Forest, ids: np.ndarray, x: np.ndarray, centre: np.ndarray, q_ids: np.ndarray, q: np.ndarray, nearest: int, least: int):
    """Query id, vector id and distance of the nearest candidates of each query."""
    out = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),)]
    strings = forest.strings(q - centre)
    for k in range(len(q)):
        c = forest.candidates(strings[:, k], least)
        c = c[ids[c] != q_ids[k]]
        gap = x[c] - q[k]
        d = np.sqrt((gap * gap).sum(1))
        if len(c) > nearest:
            near = d <= np.partition(d, nearest - 1)[nearest - 1]
            c, d = c[near], d[near]
        best = np.lexsort((ids[c], d))[:nearest]
        out.append((np.full(len(best), q_ids[k]), ids[c[best]], d[best]))
    return [np.concatenate(v) for v in zip(*out, strict=True)]


def search(vectors: DataFrame, *, every: int = 100, nearest: int = NEAREST, trees: int = TREES, bits: int = BITS, share: float = SHARE, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score for the queries, the rows whose id is divisible by ``every``."""
    rows = usable(vectors)
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    rows = rows.where(F.size("v") == dims["d"])
    shards = -(-dims["count"] // shard_rows)
    place = F.pmod(F.xxhash64("id", "v"), F.lit(1 << 40))
    own = rows.withColumns({"shard": place % shards, "asked": F.lit(False)})
    asked = rows.where(F.col("id") % every == 0).withColumns({"shard": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))), "asked": F.lit(True)})
    width = max(parallelism(vectors.sparkSession), min(shards, 4096))
    dealt = own.unionByName(asked).repartition(width, "shard").sortWithinPartitions("shard", "asked")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A shard's own vectors come first, then the queries, which are answered as they come."""
        now, held, built = None, [], None
        for b in batches:
            i = 0
            shard, is_asked = b.column(2).to_numpy(), b.column(3).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(shard) != 0) | (is_asked[1:] != is_asked[:-1])) + 1
            for j in [*edges.tolist(), b.num_rows]:
                part, i = b.slice(i, j - i), j
                if not part.num_rows:
                    continue
                ids, x = part.column(0).to_numpy(), matrix(part.column(1))
                if part.column(2)[0].as_py() != now:
                    now, held, built = part.column(2)[0].as_py(), [], None
                if not part.column(3)[0].as_py():
                    held.append((ids, x))
                    continue
                if not held:
                    continue
                if built is None:
                    own_ids, own_x = (np.concatenate(v) for v in zip(*held, strict=True))
                    centre = own_x.mean(0)
                    built = Forest(own_x - centre, trees, bits), own_ids, own_x, centre
                least = min(len(built[1]), max(nearest + 1, int(np.ceil(share * len(built[1])))))
                for k in range(0, len(ids), query_rows):
                    found = _nearest(*built, ids[k : k + query_rows], x[k : k + query_rows], nearest, least)
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in found], ["query_id", "vec_id", "score"])

    found = dealt.select("id", "v", "shard", "asked").mapInArrow(near, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
