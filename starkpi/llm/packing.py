"""Packing of tokenized documents into sequences of a fixed number of ids.

Harmonic packing: class j takes lengths of at most ``capacity // j`` (the reciprocal part of a
sequence) and its sequences hold exactly j pieces, whatever these are; nothing is searched
and no open sequence is compared with a piece.  A piece that leaves much of its class's part
empty is cut: its head takes the next smaller part whole (class j + 1) and its tail goes to
the class of its own length, and so on.  The tail is shorter than ``capacity / (j * (j + 1))``,
so that a document is cut a few times at most.  Documents of a sequence and more first give
whole sequences, which are class 1.

Every task fills the classes of its own documents and knows of no other task, which leaves
one unfinished sequence a class.  At its end a task lays the pieces of those end to end, cut
where a sequence is full, and ends the last one in sequences of a power of two, which need
no padding.

A task reads its rows once and holds the unfinished sequences, at most two for each square
root of the capacity; there is no shuffle, so that no source, key or group can be hot.
Sequences are numbered by task and place within it: the numbers are unique, not gapless,
and the same whenever the same files are read.

NULL and empty texts hold the end id alone.  Every row is a document of its own, whatever
its id; NULL ids are kept.  An empty table has no piece."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkpi.llm.common import map_arrow
from starkpi.llm.word_ids import Words, runs, with_end

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def parts(length: int, capacity: int, slack: float) -> list[tuple[int, int]]:
    """(class, length) of the pieces of a document of ``length`` ids, in order.  A piece stays
    whole where it leaves at most ``slack`` of its class's part empty."""
    out = [(1, capacity)] * (length // capacity)
    rest = length % capacity
    while rest:
        j = capacity // rest
        if rest >= (1 - slack) * (capacity // j):
            out.append((j, rest))
            break
        head = capacity // (j + 1)
        # the part of class j + 1, and of the last class of that length
        out.append((capacity // head, head))
        rest -= head
    return out


class Packer:
    """One task's open sequences.  ``add`` and ``finish`` give finished pieces as
    (doc_id, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, capacity: int, slack: float):
        self.capacity, self.slack = capacity, slack
        self.open: dict[int, list] = {}
        self.known: dict[int, list[tuple[int, int]]] = {}
        self.sequences = 0

    def _close(self, pieces: list) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in pieces:
            yield doc, start, ids, total, self.sequences, offset
            offset += len(ids)
        self.sequences += 1

    def add(self, doc: int | None, ids: np.ndarray) -> Iterator[tuple]:
        start, n = 0, len(ids)
        whole, rest = n - n % self.capacity, n % self.capacity
        for start in range(0, whole, self.capacity):
            yield from self._close([(doc, start, ids[start:start + self.capacity], n)])
        if rest not in self.known:  # at most one entry a length
            self.known[rest] = parts(rest, self.capacity, self.slack)
        start = whole
        for j, length in self.known[rest]:
            held = self.open.setdefault(j, [])
            # a copy: the batch that the ids are cut from must not stay in memory
            held.append((doc, start, ids[start:start + length].copy(), n))
            start += length
            if len(held) == j:
                yield from self._close(self.open.pop(j))

    def finish(self) -> Iterator[tuple]:
        left = [p for j in sorted(self.open) for p in self.open[j]]
        self.open = {}
        total = sum(len(p[2]) for p in left)
        while total:
            # whole sequences, then the largest power of two that is left
            room = self.capacity if total >= self.capacity else 1 << (total.bit_length() - 1)
            total -= room
            taken = []
            while room:
                doc, start, ids, n = left.pop()
                if len(ids) > room:
                    left.append((doc, start + room, ids[room:], n))
                    ids = ids[:room]
                taken.append((doc, start, ids, n))
                room -= len(ids)
            yield from self._close(taken)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, slack: float = 1 / 64,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of every piece: ``ids``
    are little-endian unsigned 32-bit integers as a token file holds them, ``start`` counts
    the ids of the document before the piece, ``offset`` those of the sequence."""
    spark = docs.sparkSession
    with open(tokenizer, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())  # the tokenizer's fixed size, some MB

    def table(rows: list[tuple], base: int) -> pa.RecordBatch:
        doc, start, ids, total, sequence, offset = zip(*rows)
        size = [len(x) for x in ids]
        return pa.RecordBatch.from_arrays([
            pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(size, pa.int64()),
            pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(total, pa.int64()),
            pa.array([base + s for s in sequence], pa.int64()), pa.array(offset, pa.int64())],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = Words.of(data.value), Packer(capacity, slack)
        base = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        for b in batches:
            at = 0
            for texts in runs(b.column(1)):
                flat, ends = with_end(*words.encode(texts), end_id)
                begin = 0
                for doc, end in zip(b.column(0).slice(at, len(texts)).to_pylist(), ends.tolist()):
                    rows += packer.add(doc, flat[begin:end])
                    begin = end
                at += len(texts)
                if rows:
                    yield table(rows, base)
                    rows = []
        rows = list(packer.finish())
        if rows:
            yield table(rows, base)

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")),
                     run, PIECES)
