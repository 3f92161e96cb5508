"""Token ids as binary files in Simple-8b word-aligned coding.

Documents are put in order of their ids by range partitions; a task encodes its documents,
appends the end id to each, packs all ids and writes files of a bounded number of ids (and
at least one document) in order.  Files are read back with Spark's binary reader and decoded
block by block with numpy.

A file (its row is the only one in its folder ``shard=N``; shards follow the id order):

  bytes 0-39   magic "S8B1", block size u32, ids u64, documents u64, blocks u64, words u64
               (big-endian, so that SQL can read them)
  then         document ids i64, flags u8 (0: the id is NULL) filled up to 8 bytes,
               document ends u64 (ids up to and including the document's last),
               block offsets u64 (words before each block, and all words),
               words u64 (all little-endian)
  last byte    a line feed, which Spark's text writer adds (it writes a string's bytes
               unchecked, so that a file's bytes travel as a string)

Each word has a 4-bit selector and 60 payload bits: selector s holds COUNTS[s] ids of
WIDTHS[s] bits, lowest bits first.  Selector 15 escapes an id of over 60 bits, which follows
as a word of its own.  Words never cross blocks; a block's last word may be filled up with
zeros, which the block's number of ids cuts off.

NULL and empty texts hold the end id alone.  Ties of an id follow the hash of their texts;
rows with the same id and text follow their place in the input.  NULL ids come first.  An
empty table writes no file and reads back no row.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starkpi.llm.common import map_arrow
from starkpi.llm.word_ids import Words, runs, with_end
from starkpi.session import scratch_path

MAGIC = b"S8B1"
HEADER = struct.Struct(">4sIQQQQ")
BLOCK = 512
# How many ids of how many bits each selector packs; 15 is the escape.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15
MOST_FILES = 1 << 20  # of one task
_PAD = int(COUNTS.max())


# ---- coding -----------------------------------------------------------------


def _bit_lengths(x: np.ndarray) -> np.ndarray:
    if len(x) and x.max() < 1 << 53:  # exact as floating point
        return np.frexp(x.astype(np.float64))[1].astype(np.uint8)
    return np.searchsorted(np.uint64(1) << np.arange(64, dtype=np.uint64), x, "right").astype(np.uint8)


def pack(ids: np.ndarray, block: int = BLOCK, together: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """(words u64, word offset of each block and the end) of ids, ``together`` blocks at a time."""
    words, sizes = [np.zeros(0, np.uint64)], [np.zeros(1, np.uint64)]
    for at in range(0, len(ids), together * block):
        some, per_block = _pack_blocks(ids[at:at + together * block].astype(np.uint64), block)
        words.append(some)
        sizes.append(per_block)
    return np.concatenate(words), np.cumsum(np.concatenate(sizes)).astype(np.uint64)


def _pack_blocks(ids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, words of each block).  Every word takes the selector that packs the most ids;
    all blocks advance together, one word at a time."""
    n_blocks = -(-len(ids) // block)
    x = np.zeros(n_blocks * block, np.uint64)
    x[:len(ids)] = ids
    x = np.pad(x.reshape(n_blocks, block), ((0, 0), (0, _PAD)))
    # widest[n]: the bits of the widest of the n ids from each position on; powers of two
    # by doubling, others as the wider of two overlapping windows
    bits = _bit_lengths(x.ravel())
    widest = {1: bits}
    while 2 * (n := max(widest)) <= COUNTS.max():
        widest[2 * n] = np.maximum(widest[n], np.append(widest[n][n:], np.zeros(n, np.uint8)))
    # the selector at every position: the first, from the most ids on, whose next ids all fit
    selector = np.full(len(bits), ESCAPE, np.uint8)
    for s in reversed(range(len(COUNTS))):
        n = 1 << (int(COUNTS[s]).bit_length() - 1)
        over = int(COUNTS[s]) - n
        fits = widest[n] <= WIDTHS[s]
        if over:
            fits[:-over] &= widest[n][over:] <= WIDTHS[s]
        selector[fits] = s
    step = np.append(COUNTS, [0] * (ESCAPE - len(COUNTS)) + [1]).astype(np.uint8)[selector]
    width = x.shape[1]
    starts = np.zeros(len(bits), bool)
    at = np.arange(n_blocks) * width
    end = at + block
    end[-1] += len(ids) - block * n_blocks
    while len(at):
        starts[at] = True
        at = at + step[at]
        live = at < end
        if not live.all():
            at, end = at[live], end[live]
    starts, selector = starts.reshape(x.shape), selector.reshape(x.shape)
    row, col = np.nonzero(starts)
    chosen = selector[row, col]
    size = np.where(chosen == ESCAPE, 2, 1)
    offset = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s, (count, width) in enumerate(zip(COUNTS, WIDTHS)):
        own = np.flatnonzero(chosen == s)
        if len(own):
            values = x[row[own][:, None], col[own][:, None] + np.arange(count)] << (np.arange(count) * width).astype(np.uint64)
            words[offset[own]] = np.bitwise_or.reduce(values, axis=1) | np.uint64(s << 60)
    own = np.flatnonzero(chosen == ESCAPE)
    words[offset[own]] = np.uint64(ESCAPE << 60)
    words[offset[own] + 1] = x[row[own], col[own]]
    return words, np.bincount(row, weights=size, minlength=n_blocks).astype(np.uint64)


def unpack(words: np.ndarray, offsets: np.ndarray, n_ids: int, block: int = BLOCK) -> np.ndarray:
    """The ids (u64) of whole blocks; ``offsets`` may be any run of block offsets, counted
    from the first word given."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    last = -2
    for i in np.flatnonzero(selector == ESCAPE):  # a raw word may look like an escape
        if i != last + 1 and i + 1 < len(words):
            raw[i + 1] = True
            last = i
    counts = np.append(COUNTS, [0] * (ESCAPE - len(COUNTS)) + [0])[selector]
    counts[raw] = 1
    before = np.concatenate([[0], np.cumsum(counts)])
    first_word = offsets[:-1].astype(np.int64)
    block_of = np.repeat(np.arange(len(first_word)), np.diff(offsets).astype(np.int64))
    within = before[:-1] - before[first_word][block_of]
    ends = np.minimum(block, n_ids - block * np.arange(len(first_word)))
    out = np.zeros(n_ids, np.uint64)

    def put(own: np.ndarray, values: np.ndarray) -> None:
        at = within[own][:, None] + np.arange(values.shape[1])
        real = at < ends[block_of[own]][:, None]
        out[(at + block * block_of[own][:, None])[real]] = values[real]

    for s, (count, width) in enumerate(zip(COUNTS, WIDTHS)):
        own = np.flatnonzero((selector == s) & ~raw)
        if len(own):
            put(own, (words[own][:, None] >> (np.arange(count) * width).astype(np.uint64)) & np.uint64((1 << int(width)) - 1))
    own = np.flatnonzero(raw)
    if len(own):
        put(own, words[own][:, None])
    return out


def to_file(doc_ids: list[int | None], flat: np.ndarray, lengths: np.ndarray) -> bytes:
    """One file's bytes (without the line feed at its end): documents of ``lengths`` ids each,
    ``flat`` all of them one after the other."""
    words, offsets = pack(flat)
    flags = np.array([d is not None for d in doc_ids], np.uint8).tobytes()
    return b"".join([
        HEADER.pack(MAGIC, BLOCK, len(flat), len(doc_ids), len(offsets) - 1, len(words)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), flags + bytes(-len(flags) % 8),
        np.cumsum(lengths).astype("<u8").tobytes(),
        offsets.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


def from_file(data: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(document ids, starts and ends within the file, their ids one after the other) of runs
    of documents, read block by block: only the blocks of a run are decoded at a time."""
    magic, block, n_ids, n_docs, n_blocks, n_words = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b token file")
    at = HEADER.size
    docs = np.frombuffer(data, "<i8", n_docs, at)
    flags = np.frombuffer(data, np.uint8, n_docs, at := at + 8 * n_docs)
    ends = np.frombuffer(data, "<u8", n_docs, at := at + n_docs + -n_docs % 8).astype(np.int64)
    offsets = np.frombuffer(data, "<u8", n_blocks + 1, at := at + 8 * n_docs).astype(np.int64)
    words = np.frombuffer(data, "<u8", n_words, at + 8 * (n_blocks + 1))
    done = 0
    while done < n_docs:
        low = int(ends[done - 1]) if done else 0
        stop = max(done + 1, int(np.searchsorted(ends, low + (1 << 20), "right")))
        high = int(ends[stop - 1])
        b0, b1 = low // block, -(-high // block)
        part = unpack(words[offsets[b0]:offsets[b1]], (offsets[b0:b1 + 1] - offsets[b0]).astype(np.uint64),
                      min(n_ids, b1 * block) - b0 * block, block)
        yield ([int(d) if f else None for d, f in zip(docs[done:stop], flags[done:stop])],
               np.concatenate([[low], ends[done:stop]]), part[low - b0 * block:high - b0 * block])
        done = stop


# ---- on Spark -----------------------------------------------------------------


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
          docs_per_range: int = 50_000, ids_per_file: int = 1 << 23) -> None:
    """Write the ids of all texts below ``path``, in ascending order of ``id_col`` (an integer).

    Ranges are cut by id, hash of the text and the row's place in the input, so that rows
    that share an id, or lack one, spread over ranges as well.  A task closes a file as soon
    as it holds ``ids_per_file`` ids, so that what it holds never grows with its range."""
    spark = docs.sparkSession
    with open(tokenizer, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())  # the tokenizer's fixed size, some MB
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("hash"),
                       F.monotonically_increasing_id().alias("row"))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // docs_per_range))
    order = [F.col("id").asc_nulls_first(), F.col("hash"), F.col("row")]
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number = Words.of(data.value), TaskContext.get().partitionId() * MOST_FILES
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal number, held
            out = pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array(
                [to_file(doc_ids, np.concatenate(parts), np.concatenate(lengths))], pa.binary())], names=["shard", "data"])
            number, held = number + 1, 0
            doc_ids.clear(), parts.clear(), lengths.clear()
            return out

        for b in batches:
            at = 0
            for texts in runs(b.column(1), min(6 << 20, ids_per_file)):
                flat, ends = with_end(*words.encode(texts), end_id)
                doc_ids += b.column(0).slice(at, len(texts)).to_pylist()
                at += len(texts)
                parts.append(flat)
                lengths.append(np.diff(ends, prepend=0))
                held += len(flat)
                if held >= ids_per_file:
                    yield close()
        if doc_ids:
            yield close()

    out = map_arrow(dealt, run, "shard long, data binary")
    # Spark's text writer writes a string's bytes as they are, wherever the path leads
    out.select("shard", F.col("data").cast("string").alias("value")).write.partitionBy("shard").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids array<int>) of every document below ``path``; start counts the ids
    of all documents before it."""
    return _read(spark, path, "doc_id long, start long, ids array<int>", lambda docs, edges, ids: [
        pa.array(docs, pa.int64()), pa.array(edges[:-1]),
        pa.ListArray.from_arrays(pa.array((edges - edges[0]).astype(np.int32)), pa.array(ids.astype(np.uint32).view(np.int32)))])


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document below ``path``; the checksum is
    of the ids as little-endian unsigned 32-bit integers."""
    def sums(docs, edges, ids):
        raw, cut = ids.astype("<u4").tobytes(), 4 * (edges - edges[0])
        return [pa.array(docs, pa.int64()), pa.array(edges[:-1]), pa.array(np.diff(edges)),
                pa.array([zlib.crc32(raw[a:b]) for a, b in zip(cut[:-1], cut[1:])], pa.int64())]

    return _read(spark, path, "doc_id long, start long, n_tokens long, ids_crc32 long", sums)


def _read(spark: SparkSession, path: str, schema: str, columns) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    if "shard" not in found.columns:  # nothing was written
        return spark.createDataFrame([], schema)
    # One row per file: how many ids all files before it hold.
    n_ids = F.conv(F.hex(F.substring("content", 9, 8)), 16, 10).cast("long")
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    base = found.select(F.col("shard").cast("long").alias("shard"), n_ids.alias("n")).select(
        F.col("shard").alias("__shard"), F.coalesce(before, F.lit(0)).alias("__before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, data in zip(b.column(0).to_pylist(), b.column(1)):
                for part in from_file(data.as_buffer().to_pybytes()):
                    yield pa.RecordBatch.from_arrays([pa.array([shard] * len(part[0]), pa.int64()), *columns(*part)],
                                                     names=["shard", *names])

    coded = map_arrow(found.select(F.col("shard").cast("long"), "content"), run, f"shard long, {schema}")
    return coded.join(base, F.col("shard") == F.col("__shard")).select(
        *[(F.col("start") + F.col("__before")).alias("start") if n == "start" else F.col(n) for n in names])


def scratch(spark: SparkSession) -> str:
    """A fresh folder under the session's checkpoint folder, which all executors share."""
    return scratch_path(spark, f"tokens-{uuid.uuid4().hex}")
