"""Importance resampling of documents towards a target distribution.

Texts are words, features all runs of up to ``longest`` consecutive words, dealt by hash into
a fixed number of buckets.  A bucket's gain is the log ratio of its share in the target texts
to its share in the documents, a document's weight the sum of its features' gains: an array
of gains, indexed by all of a text's buckets at once.  Gumbel noise from a hash of the id
turns the highest scores into a draw without replacement in proportion to the weights' powers
of e.

The draw needs the highest ``k`` of all scores.  Quantile sketches give two scores that should
bracket the k-th one; exact counts of the rows above and below the bracket say whether they
do, and widen it until they do.  Only the bracket's rows are sorted to find the cutoff, and
the rows above it, which are drawn whatever their order, to number them.  Both sorts deal rows
by ranges of (score, id, hash of the row), so that equal scores spread over tasks.

Passes over the texts: one counts buckets (a task sends one row a bucket), one scores.  What
reaches the driver and what is broadcast is one number a bucket; scored rows are written once
under ``spark.checkpoint.dir``.

NULL and empty texts have no feature, weight 0, and are never drawn where ``least_words`` is
above 0.  A NULL id hashes like an empty one and comes after all ids among equal scores.
Repeated rows are documents of their own; those with the same id and text have equal scores,
and any order among themselves.  Columns of the documents travel in the struct ``doc``, so
that their names clash with nothing.  Without target texts, or without documents, all
formulas hold as they stand; an empty table gives no row."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starkpi.llm.common import map_arrow, materialize

# Bytes outside words become blanks, A-Z lower case; bytes of other characters are word bytes.
_FOLD = bytes((c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20)
              for c in range(256))


def words_of(text: str | None, at_once: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a whole text, in runs cut at blanks."""
    raw = (text or "").encode().translate(_FOLD)
    at = 0
    while at < len(raw):
        stop = raw.find(b" ", at + at_once)
        stop = len(raw) if stop < 0 else stop
        yield raw[at:stop].split()
        at = stop


def buckets_of(text: str | None, longest: int, n_buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the features that end in them) of runs of a text."""
    tail: list[bytes] = []
    for words in words_of(text):
        found = [np.fromiter(map(zlib.crc32, words), np.int64, len(words))]
        for n in range(2, longest + 1):
            run = tail[-(n - 1):] + words
            found.append(np.fromiter((zlib.crc32(b" ".join(run[i:i + n])) for i in range(len(run) - n + 1)),
                                     np.int64, max(0, len(run) - n + 1)))
        tail = (tail + words)[-(longest - 1):] if longest > 1 else []
        yield len(words), np.concatenate(found) % n_buckets


def bucket_counts(texts: DataFrame, text_col: str = "text", longest: int = 1, n_buckets: int = 10_000) -> np.ndarray:
    """How many features of all texts every bucket holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for b in batches:
            for text in b.column(0):
                for _, found in buckets_of(text.as_py(), longest, n_buckets):
                    total += np.bincount(found, minlength=n_buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], names=["bucket", "n"])

    out = np.zeros(n_buckets, np.int64)
    counted = map_arrow(texts.select(F.col(text_col).cast("string").alias("text")), run, "bucket long, n long")
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # n_buckets rows at most
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of every one of B buckets."""
    s_all, t_all = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id, seed: int) -> int:
    """Gumbel noise in thousandths, from a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(docs: DataFrame, gain: np.ndarray, seed: int = 2024, longest: int = 1, id_col: str = "doc_id",
          text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(doc, n_words, n_features, weight, score) of every row; ``doc`` holds the columns ``keep`` (all)."""
    held = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket
    n_buckets = len(gain)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in (keep or docs.columns))).alias("doc"),
                       F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc", "n_words", "n_features", "weight", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = held.value
        for b in batches:
            size = np.zeros((4, b.num_rows), np.int64)
            for i, (doc_id, text) in enumerate(zip(b.column(1).to_pylist(), b.column(2))):
                for n_words, found in buckets_of(text.as_py(), longest, n_buckets):
                    size[:3, i] += n_words, len(found), gain[found].sum()
                size[3, i] = size[2, i] + noise(doc_id, seed)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, size)], names=names)

    schema = StructType(list(rows.schema.fields[:1]))
    for name in names[1:]:
        schema = schema.add(name, "long")
    return map_arrow(rows, run, schema)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name`` = 1, 2, 3 ... in ``order``: ranges are sorted by a task each, and a
    row's number is its place there behind the sizes of the ranges before, of which the driver
    holds one number a range."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(df.repartitionByRange(width, *order).sortWithinPartitions(*order)
                         .withColumn("__at", F.monotonically_increasing_id()))
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    before, sizes = 0, {}
    for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        sizes[r.part] = before
        before += r.n
    if not sizes:
        return placed.withColumn(name, F.lit(None).cast("long")).drop("__at")
    starts = df.sparkSession.createDataFrame(list(sizes.items()), "__part long, __before long")
    return placed.join(F.broadcast(starts), part == F.col("__part")).withColumn(
        name, F.col("__before") + place + 1).drop("__at", "__part", "__before")


def bracket(scores: DataFrame, k: int, n: int, accuracy: int = 10_000) -> tuple[int, int, int]:
    """(low, high, rows above high) such that the k-th highest of the n scores is within
    [low, high]: approximate quantiles around it, checked and widened by exact counts."""
    reach = 2 / accuracy
    while True:
        at = 1 - k / n
        low, high = scores.agg(F.percentile_approx("score", [max(0.0, at - reach), min(1.0, at + reach)], accuracy)).first()[0]
        ends = scores.agg(F.min("score"), F.max("score"), F.count_if(F.col("score") > high),
                          F.count_if(F.col("score") >= low)).first()
        least, most, above, at_least = ends
        if above < k <= at_least:
            return low, high, above
        if (low, high) == (least, most):
            raise AssertionError("the bracket holds all rows")
        reach *= 4


def draw(scored: DataFrame, percent: int = 10, least_words: int = 20, id_field: str = "doc_id") -> DataFrame:
    """``scored`` (materialized: it is read several times) with ``rank``: 1, 2, 3 ... by falling
    score and rising id over the floor(percent N / 100) highest of the N rows of at least
    ``least_words`` words, NULL elsewhere."""
    fits = F.col("n_words") >= least_words
    rest = scored.withColumn("rank", F.lit(None).cast("long"))
    able = scored.where(fits)
    n = able.count()
    k = percent * n // 100
    if not k:
        return rest
    low, high, above = bracket(able.select("score"), k, n)
    order = [F.col("score").desc(), F.col(f"doc.`{id_field}`").asc_nulls_last(), F.xxhash64("doc")]
    top = numbered(able.where(F.col("score") > high), order, "rank")
    near = numbered(able.where(F.col("score").between(low, high)), order, "rank")
    near = near.withColumn("rank", F.when(F.col("rank") <= k - above, F.col("rank") + above))
    return top.unionByName(near).unionByName(rest.where(~fits | (F.col("score") < low)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1,
             n_buckets: int = 10_000, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(doc, n_words, n_features, weight, score, rank) of every row of ``docs``; those with a
    rank are the draw."""
    gain = gains(bucket_counts(docs, text_col, longest, n_buckets), bucket_counts(target, target_text_col, longest, n_buckets))
    keep = list(dict.fromkeys([id_col, *(keep or docs.columns)]))
    scored = materialize(score(docs, gain, seed, longest, id_col, text_col, keep))
    return draw(scored, percent, least_words, id_col)
