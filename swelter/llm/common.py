"""Shared helpers: durable checkpoints, text keys and vectorised word hashing over Arrow buffers."""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are hashed in slices of at most this many bytes (one longer text makes a slice of its own).
SLICE_BYTES = 512 << 10
#: Rows cross to Python in batches of about this many bytes (one longer row makes a batch of its own).
BATCH_BYTES = 4 << 20

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE, _WORD_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
MAX64 = np.uint64(0xFFFFFFFFFFFFFFFF)

#: Words divided by ASCII white space (0x20, 0x09-0x0D).
BLANK_WORDS = np.ones(256, bool)
BLANK_WORDS[[0x20, *range(0x09, 0x0E)]] = False
#: Words of digits, ASCII letters and every non-ASCII character.
PLAIN_WORDS = np.zeros(256, bool)
PLAIN_WORDS[0x30:0x3A] = PLAIN_WORDS[0x41:0x5B] = PLAIN_WORDS[0x61:0x7B] = PLAIN_WORDS[0x80:] = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only in local mode, where one machine does all."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="spark-shared-")


def durable(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage through files in the shared folder, so that the result outlives executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager)


def small_batches(df: DataFrame) -> DataFrame:
    """Sees to it that Arrow batches are bounded by bytes, not only by rows, so that long texts do not pile up in a worker."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(col: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text (null counts as empty)."""
    t = F.coalesce(col, F.lit(""))
    return F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(0x5EED), t).alias("k2")


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and the offsets of its rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES):
    """Row ranges whose texts have at most ``most`` bytes together, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    at = int(base)
    if at not in _POWERS or len(_POWERS[at][0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, base, np.uint64)
        up[0] = 1
        down = np.full(size, np.uint64(pow(at, -1, 1 << 64)), np.uint64)
        down[0] = 1
        _POWERS[at] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[at][0][:n], _POWERS[at][1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def byte_sums(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Prefix sums from which :func:`span_hashes` takes the hash of any byte span."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * powers(_BASE, len(data))[0], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed((sums[ends] - sums[starts]) * powers(_BASE, len(sums))[1][starts])


class Words:
    """The words of one slice of texts: byte spans, 64-bit hashes of their lower-cased (A-Z only) bytes, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        word = kind[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = word[:-1]
        before[edge[:-1]] = False
        after = np.zeros(len(data), bool)
        after[:-1] = word[1:]
        after[edge[1:]] = False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.hashes = span_hashes(byte_sums(data, lower=True), self.starts, self.ends)
        self.sums = np.zeros(len(self.hashes) + 1, np.uint64)
        np.cumsum(self.hashes * powers(_WORD_BASE, len(self.hashes))[0], out=self.sums[1:])

    def left(self) -> np.ndarray:
        """For each word, the number of words from it to the end of its text."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.hashes))

    def grams(self, n: int) -> np.ndarray:
        """The hash of the n words from each word on; the largest value where the text ends before."""
        out = np.full(len(self.hashes), MAX64)
        at = np.flatnonzero(self.left() >= n)
        out[at] = mixed((self.sums[at + n] - self.sums[at]) * powers(_WORD_BASE, len(self.sums))[1][at]) & np.uint64(MAX64 - np.uint64(1))
        return out


def window_minima(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of x[i:i+w] for each i with a full window, in O(n log w)."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    span, m = 1, x
    while span * 2 <= w:
        m = np.minimum(m[: len(m) - span], m[span:])
        span *= 2
    return np.minimum(m[:n], m[w - span : w - span + n])


def selected(x: np.ndarray, w: int) -> np.ndarray:
    """Positions that hold the minimum of some full window of w values (winnowing; all ties are kept)."""
    low = window_minima(x, w)
    if not len(low):
        return np.zeros(0, np.int64)
    pad = np.zeros(w - 1, np.uint64)
    highest = ~window_minima(~np.concatenate([pad, low, pad]), w)
    return np.flatnonzero((x == highest) & (x != MAX64))


def in_sorted(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index of each value in a sorted array, or -1."""
    if not len(table):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return np.where(table[at] == x, at, -1)


def unique_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
