"""Ranked lexical search over K2-treaps of the term-document grid.

``build`` cuts the documents into shards, each a range of rows of one task.  A shard is a grid
of term rows and document columns whose cells hold the impact of a term in a document, kept
as a K2-treap: a quadtree that halves rows and columns at every level, whose nodes store the
largest impact below them and a bit for each child that is not empty.  It is compressed: a
node with one cell left is a leaf that names the cell.  Terms are rows by falling document
frequency, so that dense rows lie together; more rows than columns make several trees, one
below the other.

``search`` takes all of an item's terms at once: a range of documents is held with one node
for each term (the node on the term's row path over these columns), and its bound is the sum
of the terms' weights times their nodes' maxima.  The ranges with the highest bounds go first;
they split in two, each term's path taking its own child, until ranges are single documents,
whose bound is their score.  Ranges whose bound is below the worst of the best documents found
are never opened, which loses nothing: a bound is never below a score in its range, and equal
ones are opened.  A task carries an item's best documents from shard to shard.

Impacts need the number of documents and terms, so the texts are read twice; the index is
written once under ``spark.checkpoint.dir``, one row a shard, and holds every term, whatever
is searched for.  A shard closes at a bounded number of cells and bytes of terms, and lies in a
row group of its own, so that what a task holds does not grow with its range.  Items are taken
in blocks of bounded size against all shards; a block's document frequencies come from the
shards' dictionaries alone.  A task sends its best ``top`` documents of each item; nothing
grows with a term's frequency.

NULL and texts without a term match nothing, as documents and as items.  Every row is a
document or an item of its own, whatever its id: repeated ids give repeated rows.  Among equal
scores NULL ids come last, and repeated ids in any order.  Other columns are never read."""

from __future__ import annotations

import heapq
import math
import struct
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starkpi.llm.common import map_arrow, materialize
from starkpi.llm.importance import words_of
from starkpi.session import scratch_path

_POPCOUNT = np.array([bin(i).count("1") for i in range(16)], np.int64)
# Bits of a 16-bit number with a gap behind each.
_SPREAD = np.array([sum(((i >> b) & 1) << (2 * b) for b in range(16)) for i in range(1 << 16)], np.int64)
_LEVEL = struct.Struct("<QQ")
# Rows of some MB, each in a row group of its own: readers and writers hold one at a time.
_ONE_BY_ONE = {"compression": "zstd", "parquet.enable.dictionary": "false", "parquet.block.row.count.limit": "1"}


# ---- the grid -----------------------------------------------------------------


def build_treap(rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray, bits: int) -> bytes:
    """The K2-treap over 2**bits columns of distinct cells (row, column, impact)."""
    side = (1 << bits) - 1
    keys = ((rows.astype(np.int64) >> bits) << (2 * bits)) | (_SPREAD[rows & side] << 1) | _SPREAD[cols]
    order = np.argsort(keys)
    keys, rows, cols, impacts = keys[order], rows[order], cols[order], impacts[order].astype(np.uint32)
    out = [struct.pack("<B", bits)]
    for level in range(bits + 1):
        cell = keys >> (2 * (bits - level))
        starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
        size = np.diff(np.append(starts, len(cell)))
        largest = np.maximum.reduceat(impacts, starts) if len(starts) else impacts
        single = size == 1
        mask = np.zeros(len(starts), np.uint8)
        if level < bits:
            child = (keys >> (2 * (bits - level - 1))) & 3
            has = [np.bitwise_or.reduceat((child == c).astype(np.uint8), starts) << c if len(starts) else mask for c in range(4)]
            mask = np.where(single, 0, has[0] | has[1] | has[2] | has[3]).astype(np.uint8)
        at = starts[single]
        out += [_LEVEL.pack(len(starts), len(at)), mask.tobytes(), largest.astype("<u4").tobytes(),
                (rows[at] & side).astype("<u2").tobytes(), cols[at].astype("<u2").tobytes()]
        more = np.repeat(~single, size)
        keys, rows, cols, impacts = keys[more], rows[more], cols[more], impacts[more]
    return b"".join(out)


class Treap:
    """A K2-treap read from its bytes."""

    def __init__(self, data: bytes):
        self.bits, at = data[0], 1
        self.levels = []
        for _ in range(self.bits + 1):
            n, m = _LEVEL.unpack_from(data, at)
            at += _LEVEL.size
            mask = np.frombuffer(data, np.uint8, n, at)
            largest = np.frombuffer(data, "<u4", n, at := at + n)
            row = np.frombuffer(data, "<u2", m, at := at + 4 * n)
            col = np.frombuffer(data, "<u2", m, at := at + 2 * m)
            at += 2 * m
            children = np.cumsum(_POPCOUNT[mask]) - _POPCOUNT[mask]
            self.levels.append((mask, largest.astype(np.int64), children, np.cumsum(mask == 0) - 1, row, col))

    def _settle(self, level: int, rng, term, node, rows) -> tuple:
        """Cells (range, term, node, column, impact) of nodes; a leaf's column is known, others
        have -1; leaves of other rows go."""
        mask, largest, _, leaf, leaf_row, leaf_col = self.levels[level]
        col = np.full(len(node), -1, np.int64)
        own = np.flatnonzero(mask[node] == 0)
        if len(own):
            number = leaf[node[own]]
            keep = np.ones(len(node), bool)
            keep[own] = leaf_row[number] == rows[term[own]]
            col[own] = leaf_col[number]
            rng, term, node, col = rng[keep], term[keep], node[keep], col[keep]
        return rng, term, node, col, largest[node]

    def search(self, rows: np.ndarray, weights: np.ndarray, found: Best, at_once: int = 256) -> None:
        """Offer ``found`` all columns that can be among its best: ``rows`` of the grid have
        ``weights``."""
        bits = self.bits
        low = rows & ((1 << bits) - 1)
        term = np.arange(len(rows))
        cells = self._settle(0, np.zeros(len(rows), np.int64), term, rows >> bits, low)
        # A group: ranges of one level as (first column >> its width, bound) and their cells.
        heap: list[tuple] = []
        number = 0

        def push(level: int, columns: np.ndarray, bounds: np.ndarray, cells: tuple) -> None:
            nonlocal number
            if len(columns):
                heapq.heappush(heap, (-float(bounds.max()), number, level, columns, bounds, cells))
                number += 1

        bound = float((weights[cells[1]] * cells[4]).sum())
        push(0, np.zeros(1, np.int64), np.array([bound]), cells)
        while heap:
            best, _, level, columns, bounds, cells = heapq.heappop(heap)
            if -best < found.floor:
                break
            go = bounds >= found.floor
            if go.sum() > at_once:
                go &= bounds >= np.partition(bounds, -at_once)[-at_once]
                stay = (bounds >= found.floor) & ~go
                push(level, *self._part(columns, bounds, cells, stay))
            columns, bounds, cells = self._part(columns, bounds, cells, go)
            if level == bits:
                found.offer(columns, bounds)
                continue
            push(level + 1, *self._split(level, columns, cells, low, weights))

    @staticmethod
    def _part(columns, bounds, cells, keep) -> tuple:
        if keep.all():
            return columns, bounds, cells
        place = np.cumsum(keep) - 1
        own = keep[cells[0]]
        return columns[keep], bounds[keep], (place[cells[0][own]], *(c[own] for c in cells[1:]))

    def _split(self, level: int, columns: np.ndarray, cells: tuple, low: np.ndarray, weights: np.ndarray) -> tuple:
        rng, term, node, col, value = cells
        mask, _, children, *_ = self.levels[level]
        shift = self.bits - level - 1
        known = col >= 0
        # leaves follow their column
        leaves = (2 * rng[known] + ((col[known] >> shift) & 1), term[known], node[known], col[known], value[known])
        rng, term, node = rng[~known], term[~known], node[~known]
        bit, first, row = mask[node], children[node], 2 * ((low[term] >> shift) & 1)
        parts = []
        for c in range(2):
            code = row + c
            own = np.flatnonzero((bit >> code) & 1)
            below = first[own] + _POPCOUNT[bit[own] & ((1 << code[own]) - 1)]
            parts.append(self._settle(level + 1, 2 * rng[own] + c, term[own], below, low))
        cells = tuple(np.concatenate(x) for x in zip(leaves, *parts))
        # whole numbers, below 2**53 and so exact for items of up to 300,000 words
        bounds = np.bincount(cells[0], weights=weights[cells[1]] * cells[4], minlength=2 * len(columns))
        return self._part(np.repeat(2 * columns, 2) + np.tile([0, 1], len(columns)), bounds, cells, bounds > 0)


class Best:
    """The best ``top`` documents of one item so far: by falling score, then id, NULL last."""

    def __init__(self, top: int):
        self.top, self.rows, self.floor = top, [], 1.0
        self.ids: list = []

    def offer(self, columns: np.ndarray, scores: np.ndarray) -> None:
        self.rows += [(-int(s), self.ids[c] is None, self.ids[c] or 0) for c, s in zip(columns.tolist(), scores.tolist())]
        if len(self.rows) >= self.top:
            self.rows = sorted(self.rows)[:self.top]
            self.floor = float(-self.rows[-1][0])


# ---- on Spark -----------------------------------------------------------------


class _Numbers(dict):
    """Numbers words as they come; ``size`` counts their bytes."""

    size = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.size += len(word)
        return number


def _shard(ids: list[int | None], vocabulary: dict, terms: list, counts: list, lengths: list, n_docs: int, n_terms: int) -> list:
    """(documents, their ids, terms, document frequencies, treap) as bytes."""
    cols = np.repeat(np.arange(len(ids)), [len(t) for t in terms])
    term, tf = np.concatenate(terms), np.concatenate(counts)
    df = np.bincount(term, minlength=len(vocabulary))
    order = np.argsort(-df, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    m = np.array([75 + 25 * n * n_docs // n_terms for n in lengths], np.int64)
    impacts = 1_000_000_000 * tf // (1000 * tf + 12 * m[cols])
    names = list(vocabulary)
    bits = max(1, (len(ids) - 1).bit_length())
    known = np.array([i is not None for i in ids], np.uint8)
    return [len(ids), known.tobytes() + np.array([i or 0 for i in ids], "<i8").tobytes(),
            b" ".join(names[i] for i in order.tolist()), df[order].astype("<u4").tobytes(),
            build_treap(place[term], cols, impacts, bits)]


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", postings: int = 1 << 19,
          term_bytes: int = 8 << 20) -> str:
    """Write the index of all texts, shards of about ``postings`` cells or ``term_bytes`` bytes
    of terms, and give its folder."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        for b in batches:
            for text in b.column(0):
                n = sum(map(len, words_of(text.as_py())))
                n_docs += n > 0
                n_terms += n
        yield pa.RecordBatch.from_arrays([pa.array([n_docs], pa.int64()), pa.array([n_terms], pa.int64())], names=["n_docs", "n_terms"])

    n_docs, n_terms = map_arrow(rows.select("text"), size, "n_docs long, n_terms long").agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, terms, counts, lengths, held = [], [], [], [], 0
        vocabulary = _Numbers()

        def close() -> pa.RecordBatch:
            nonlocal number, ids, terms, counts, lengths, held, vocabulary
            columns = [number, n_docs, *_shard(ids, vocabulary, terms, counts, lengths, n_docs, n_terms)]
            number += 1
            ids, terms, counts, lengths, held, vocabulary = [], [], [], [], 0, _Numbers()
            types = [pa.int64(), pa.int64(), pa.int32()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, types)], names=names)

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                n, parts = 0, []
                for words in words_of(text.as_py()):
                    n += len(words)
                    parts.append(np.unique(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)), return_counts=True))
                if not n:
                    continue
                term, tf = parts[0]
                if len(parts) > 1:  # a long text came in runs
                    term, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                    tf = np.bincount(back, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
                ids.append(doc_id)
                terms.append(term)
                counts.append(tf)
                lengths.append(n)
                held += len(term)
                if held >= postings or vocabulary.size >= term_bytes or len(ids) == 1 << 16:
                    yield close()
        if ids:
            yield close()

    names = ["shard", "n_docs", "size", "ids", "terms", "df", "treap"]
    path = scratch_path(spark, f"lexical-{uuid.uuid4().hex}")
    map_arrow(rows, run, "shard long, n_docs long, size int, ids binary, terms binary, df binary, treap binary") \
        .write.options(**_ONE_BY_ONE).parquet(path)
    return path


def _prepared(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, terms, counts, size): an item's distinct terms and how often it has them."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"),
                        F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [Counter(w for run in words_of(t.as_py()) for w in run) for t in b.column(2)]
            terms = [b" ".join(c) for c in own]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array(terms, pa.binary()), pa.array([list(c.values()) for c in own], pa.list_(pa.int64())),
                pa.array([len(t) + 8 * len(c) for t, c in zip(terms, own)], pa.int64())], names=["item", "item_id", "terms", "counts", "size"])

    id_type = rows.schema["item_id"].dataType.simpleString()
    return map_arrow(rows, run, f"item long, item_id {id_type}, terms binary, counts array<long>, size long")


def _places(terms: bytes, wanted: pa.Array) -> np.ndarray:
    """The row of each wanted term in a shard, -1 where it has none."""
    found = pc.index_in(wanted, value_set=pa.array(terms.split(b" "), pa.binary()))
    return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def search(spark: SparkSession, path: str, items: DataFrame, top: int = 20, id_col: str = "item_id",
           text_col: str = "text", block_bytes: int = 16 << 20) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``top`` documents with the highest scores above 0
    for every item, equal scores by rising id."""
    index = spark.read.parquet(path)
    prepared = materialize(_prepared(items, id_col, text_col))
    total = prepared.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    blocks = -(-total // block_bytes) or 1
    found = []
    for block in range(blocks):
        own = prepared.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "terms", "counts").collect()
        best = _search_block(index, [(r.item, bytes(r.terms).split(), r.counts) for r in own], top)
        found.append(best if blocks == 1 else materialize(best))
    best = found[0]
    for other in found[1:]:
        best = best.unionByName(other)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(prepared.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _search_block(index: DataFrame, items: list[tuple], top: int) -> DataFrame:
    """(item, doc_id, score): every task's best documents of each item of a bounded block."""
    spark = index.sparkSession
    wanted = sorted({t for _, terms, _ in items for t in terms})
    held = spark.sparkContext.broadcast(wanted)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(held.value, pa.binary())
        total, n_docs = np.zeros(len(terms), np.int64), 0
        for b in batches:
            for own, df, n in zip(b.column(0), b.column(1), b.column(2).to_pylist()):
                at = _places(own.as_py(), terms)
                total[at >= 0] += np.frombuffer(df.as_py(), "<u4")[at[at >= 0]]
                n_docs = n
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own]), pa.array(np.full(len(own), n_docs))], names=["term", "df", "n"])

    weight = np.zeros(len(wanted), np.int64)
    counted = map_arrow(index.select("terms", "df", "n_docs"), frequencies, "term long, df long, n long")
    for r in counted.groupBy("term").agg(F.sum("df").alias("df"), F.max("n").alias("n")).collect():  # the block's terms at most
        weight[r.term] = math.floor(1000 * math.log((2.0 * r.n + 2) / (2.0 * r.df + 1)))
    number = {t: i for i, t in enumerate(wanted)}
    asked = []
    for item, terms, counts in items:
        own = np.array([number[t] for t in terms], np.int64)
        weights = weight[own] * np.array(counts, np.int64)
        if (weights > 0).any():
            asked.append((item, own[weights > 0], weights[weights > 0]))
    plan = spark.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(held.value, pa.binary())
        best = [Best(top) for _ in plan.value]
        for b in batches:
            for size, ids, own, treap in zip(*(b.column(i) for i in range(4))):
                size, ids = size.as_py(), ids.as_py()
                known = np.frombuffer(ids, np.uint8, size)
                doc_ids = [i if k else None for i, k in zip(np.frombuffer(ids, "<i8", size, size).tolist(), known.tolist())]
                at = _places(own.as_py(), terms)
                grid = Treap(treap.as_py())
                for found, (_, number, weights) in zip(best, plan.value):
                    rows = at[number]
                    if (rows >= 0).any():
                        found.ids = doc_ids
                        grid.search(rows[rows >= 0], weights[rows >= 0], found)
        out = [(item, None if null else i, -s) for found, (item, _, _) in zip(best, plan.value) for s, null, i in sorted(found.rows)[:top]]
        item, doc_id, score = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (item, doc_id, score)], names=["item", "doc_id", "score"])

    return map_arrow(index.select("size", "ids", "terms", "treap"), run, "item long, doc_id long, score long")
