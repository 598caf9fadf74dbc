"""Token counts of whole texts; huge ones are encoded in overlapping chunks that are spliced where both sides agree.

Overlap resynchronisation: a text of more than ``CHUNK`` bytes is dealt out as chunks that overlap. Each is encoded by itself with
offsets. The vocabulary splits text into pre-tokens by a pattern that looks at nothing before the place where it stands, so two
encodings that both start a pre-token at the same place go on alike from there. A chunk's boundary is stable unless it lies within
``AHEAD`` characters of the chunk's end, as far as the pattern and special tokens look forward. The first stable boundary of a chunk
that the next chunk has too is where they are spliced: by induction from the start of the text, all tokens up to it are those of the whole text.
Where two chunks have none in common (a run without a boundary), the text is dealt out again with ``WIDER`` times the overlap and
chunk, in the end in one piece. So a task holds one chunk, or the longest run between two boundaries.

Chunks are rows and neighbours meet in a window by (document, chunk); what meets are boundaries and counts, not text. Null and empty
texts have no tokens. Repeated rows are counted each. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swelter.llm.common import durable, small_batches, text_buffer, text_key
from swelter.llm.packing import Encoder

#: Bytes of a chunk and of the overlap of two; texts of up to a chunk are encoded whole.
CHUNK, OVERLAP, WIDER = 64 << 10, 1 << 10, 8
#: Characters that a special token or the pattern may look forward (the longest special token of the vocabulary has 13).
AHEAD = 32
LIMIT = 512

PIECE = "doc_id long, k1 long, k2 long, n_bytes long, chunk long, last boolean, start long, body string"
COUNTED = "doc_id long, k1 long, k2 long, n_bytes long, chunk long, last boolean, n long, head array<long>, head_n array<long>, tail array<long>, tail_n array<long>"


def boundaries(tokenizer, text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Places (in characters) where pre-tokens start, the tokens before each, and all tokens."""
    e = tokenizer.encode(text, add_special_tokens=False)
    words = np.array(e.word_ids, np.int64)
    at = np.flatnonzero(np.diff(words, prepend=-1))
    starts = np.array(e.offsets, np.int64).reshape(-1, 2)[at, 0]
    return starts, at, len(words)


def byte_places(text: str, places: np.ndarray) -> np.ndarray:
    """Byte offsets of ascending character places."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    return np.concatenate([[0], np.cumsum(width)])[places]


def cuts(data: np.ndarray, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Start and end of each chunk; neither divides a character."""

    def whole(at: int) -> int:
        while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
            at -= 1
        return at

    starts = [whole(s) for s in range(0, max(1, len(data) - overlap), chunk)]
    return [(s, whole(min(len(data), s + chunk + overlap))) for s in starts[:-1]] + [(starts[-1], len(data))]


def _supported(tokenizer) -> None:
    """The proof needs a byte-level vocabulary without normalisation or white space taken up by special tokens."""
    special = tokenizer.get_added_tokens_decoder().values()
    if tokenizer.normalizer is not None or "ByteLevel" not in repr(tokenizer.pre_tokenizer) or any(t.lstrip or t.rstrip or t.single_word or len(t.content) >= AHEAD for t in special):
        raise ValueError("only byte-level vocabularies without normalisation can be encoded in chunks")


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """A row for each chunk of each text."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_buffer(b.column(4))
            for r in range(b.num_rows):
                text = data[offsets[r] : offsets[r + 1]]
                spans = cuts(text, chunk, overlap)
                for k in range(0, len(spans), 64):
                    some = spans[k : k + 64]
                    n = len(some)
                    same = [pa.array([b.column(c)[r].as_py()] * n, pa.int64()) for c in range(4)]
                    bodies = pa.array([text[s:e].tobytes() for s, e in some], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([*same, pa.array(range(k, k + n), pa.int64()), pa.array([k + i == len(spans) - 1 for i in range(n)]), pa.array([s for s, _ in some], pa.int64()), bodies], ["doc_id", "k1", "k2", "n_bytes", "chunk", "last", "start", "body"])

    return small_batches(long).mapInArrow(deal, PIECE)


def _counted(chunks: DataFrame, vocabulary: str, overlap: int) -> DataFrame:
    """Tokens of each chunk, and the boundaries in its overlaps with the tokens before them: all in the head, the stable ones in the tail."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        for b in batches:
            rows = []
            for r in range(b.num_rows):
                doc, k1, k2, size, k, last, start, text = (b.column(c)[r].as_py() for c in range(8))
                starts, at, n = boundaries(tokenizer, text)
                place = byte_places(text, starts)
                # cuts lie up to three bytes before their round number
                tail = (starts <= len(text) - AHEAD) & (place >= len(text.encode()) - overlap - 4)
                head = place <= overlap + 4
                place += start
                rows.append((doc, k1, k2, size, k, last, n, place[head].tolist(), at[head].tolist(), place[tail].tolist(), at[tail].tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], kind) for c, kind in enumerate([pa.int64()] * 5 + [pa.bool_(), pa.int64()] + [pa.list_(pa.int64())] * 4)], ["doc_id", "k1", "k2", "n_bytes", "chunk", "last", "n", "head", "head_n", "tail", "tail_n"])

    return chunks.mapInArrow(count, COUNTED)


def _at(values: str, places: str, where: Column) -> Column:
    return F.get(F.col(values), (F.array_position(F.col(places), where) - 1).cast("int"))


def _spliced(counted: DataFrame) -> DataFrame:
    """A row per text: n_tokens, null where two neighbours have no boundary in common, and how many equal rows there are."""
    keys = ["doc_id", "k1", "k2", "n_bytes"]
    # equal rows give equal chunks
    one = counted.groupBy(*keys, "chunk").agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("last", "n", "head", "head_n", "tail", "tail_n")))
    order = Window.partitionBy(*keys).orderBy("chunk")
    # the first place that this chunk (stable) and the next have in common
    join = lambda mine, theirs: F.array_min(F.array_intersect(mine, theirs))
    one = one.withColumn("upto", join(F.col("tail"), F.lead("head").over(order))).withColumn("since", F.lag("upto").over(order))
    ends = F.when(F.col("last"), F.col("n")).otherwise(_at("tail_n", "tail", F.col("upto")))
    begins = F.when(F.col("chunk") == 0, F.lit(0)).otherwise(_at("head_n", "head", F.col("since")))
    out = one.withColumn("own", ends - begins).groupBy(*keys).agg(F.sum("own").alias("total"), F.count("own").alias("found"), F.count("*").alias("parts"), F.max("copies").alias("copies"))
    return out.select(*keys, F.when(F.col("found") == F.col("parts"), F.col("total")).alias("n_tokens"), "copies")


def token_counts(docs: DataFrame, vocabulary: str, ranks: str | None = None, *, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    from tokenizers import Tokenizer

    if overlap * 2 >= chunk:
        raise ValueError("a chunk must be longer than its two overlaps")
    _supported(Tokenizer.from_file(vocabulary))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(vocabulary, ranks)
        for b in batches:
            data, offsets = text_buffer(b.column(1))
            counts = [len(encode(data[s:e].tobytes())) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offsets)), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    out = rows.where(size <= chunk).mapInArrow(whole, "doc_id long, n_bytes long, n_tokens long")
    k1, k2 = text_key(F.col("text"))
    long = rows.where(size > chunk).select("doc_id", k1, k2, size.cast("long").alias("n_bytes"), "text")
    pending = long
    while True:
        # equal rows of different partitions are not brought together
        dealt = _chunks(pending, chunk, overlap).repartition("doc_id", "k1", "k2", "chunk", F.spark_partition_id())
        spliced = durable(_spliced(_counted(dealt, vocabulary, overlap)))
        good = spliced.where("n_tokens is not null")
        out = out.unionByName(good.withColumn("_c", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("doc_id", "n_bytes", "n_tokens"))
        open_ = spliced.where("n_tokens is null").select("doc_id", "k1", "k2")
        if not open_.take(1):
            break
        # a null doc_id is a key too
        same = [long[c].eqNullSafe(open_[c]) for c in ("doc_id", "k1", "k2")]
        pending = long.join(open_, same[0] & same[1] & same[2], "left_semi")
        chunk, overlap = chunk * WIDER, overlap * WIDER
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
