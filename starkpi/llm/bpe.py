"""Byte-level BPE encoding and decoding with recursive DuckDB queries per partition.

Encoding: a text is cut into pieces by the vocabulary's pattern; every piece not met lately
becomes a word of token-position rows.  One recursive query per batch joins neighbouring
tokens with the merge table, contracts each word's leftmost pair of minimum rank, and goes
on until no pair of any word is left in the table.  Decoding: a query per batch looks each
text's ids up in the vocabulary, which is one list there, in their order, and puts their bytes
together; ids that the vocabulary lacks are left out.

Everything happens inside map tasks, without a shuffle: a task holds one Arrow batch, a
slice of it being cut into pieces, and a cache of pieces bounded by ``cache_entries`` that
only saves work (a dropped entry is computed again).  The vocabulary file is read once on the
driver and broadcast; it has a fixed size (under 1 MB).

NULL and empty texts have no ids and decode to no bytes; NULL id arrays decode like empty
ones.  Special tokens do not exist here: their strings are ordinary text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkpi.llm.common import map_arrow

# Fixed value: how byte-level vocabularies of this family cut a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same cut for texts of plain and accented Latin, in the standard library's syntax,
# which is twice as fast; any other character sends the text to the pattern itself.
_LATIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ſ]*")
_LATIN_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
# A lone space between two other characters always begins a piece.
_CUT = re.compile(r"(?<=[^\s]) (?=[^\s])")
_SLICE = 1 << 20
_TOGETHER = 1 << 23
_CHUNK = 1 << 18  # bytes of ids decoded as one group, at most

_ENCODE = """
with recursive words(w, l) as (
  select w, l from fresh
  union all (
    with pairs as (
      select w, unnest(l[:-2]) as a, unnest(l[2:]) as b, unnest(range(1, len(l))) as i from words),
    best as (
      select w, min((merges.rank::bigint << 32) | i) as x
      from pairs join merges on merges.pair = ((a::bigint << 32) | b) group by w)
    select w, l[:((x & 4294967295) - 1)] || [(x >> 32)::int] || l[((x & 4294967295) + 2):]
    from words join best using (w)))
select w, arg_min(l, len(l)) as l from words group by w order by w
"""
# l holds places in the list, from 1; there is nothing at 0
_DECODE = """
select s, unhex(coalesce(array_to_string(list_select(hexes, l), ''), '')) as bytes from fresh, vocabulary order by s
"""


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank from the lines ``base64 rank``."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


def _lists(buffers: list[bytes], change=lambda values: values) -> pa.Array:
    """Arrow lists of int32 from little-endian buffers, their values as ``change`` makes them."""
    ends = np.zeros(len(buffers) + 1, dtype=np.int32)
    np.cumsum([len(b) // 4 for b in buffers], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(change(np.frombuffer(b"".join(buffers), dtype="<i4"))))


def _flat(lists: pa.ChunkedArray) -> list[bytes]:
    """The opposite of ``_lists``."""
    out = []
    for chunk in lists.chunks:
        ends = 4 * chunk.offsets.to_numpy().astype(np.int64)
        raw = chunk.values.to_numpy(zero_copy_only=False).astype("<i4").tobytes()
        out += [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]
    return out


def pieces(text: str, pattern: str = PATTERN) -> Iterator[list[str]]:
    """The pieces of a text, in lists of bounded size."""
    at = 0
    while at < len(text):
        stop = len(text)
        if stop - at > _SLICE and (cut := _CUT.search(text, at + _SLICE)):
            stop = cut.start()
        part = text[at:stop]
        if pattern == PATTERN and _LATIN.fullmatch(part):
            yield _LATIN_PIECE.findall(part)
        else:
            yield regex.findall(pattern, part)
        at = stop


class Codec:
    """Encoder and decoder of one worker: a DuckDB connection with the merge table and the
    vocabulary, and a cache of encoded pieces."""

    _held: dict[int, Codec] = {}

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, cache_entries: int = 300_000):
        import duckdb
        self.ranks, self.pattern, self.limit = ranks, pattern, cache_entries
        self.encoded: dict[str, bytes] = {}
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        pair, rank = [], []
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pair.append((a << 32) | b)
                    rank.append(r)
        spelled = sorted((r, token.hex()) for token, r in ranks.items())
        self.known = np.array([r for r, _ in spelled], dtype=np.int32)
        tables = {"merges": pa.table({"pair": pa.array(pair, pa.int64()), "rank": pa.array(rank, pa.int32())}),
                  "vocabulary": pa.table({"hexes": pa.array([[h for _, h in spelled]], pa.list_(pa.string()))})}
        for name, table in tables.items():
            self.con.register("given", table)
            self.con.execute(f"create table {name} as select * from given")
            self.con.unregister("given")
        self.byte_id = np.array([ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int32)

    @classmethod
    def of(cls, data: bytes, pattern: str = PATTERN, cache_entries: int = 300_000) -> Codec:
        """The worker's codec for a vocabulary; workers live on from task to task."""
        key = hash((data, pattern, cache_entries))
        if key not in cls._held:
            cls._held.clear()
            cls._held[key] = cls(read_ranks(data), pattern, cache_entries)
        return cls._held[key]

    def _query(self, sql: str, column: str, lists: pa.Array) -> pa.ChunkedArray:
        fresh = pa.table({column: pa.array(np.arange(len(lists), dtype=np.int32)), "l": lists})
        self.con.register("fresh", fresh)
        try:
            return self.con.sql(sql).to_arrow_table().column(1)
        finally:
            self.con.unregister("fresh")

    def _learn(self, fresh: list[str]) -> None:
        """Encode the pieces ``fresh`` into the cache."""
        unmerged, raws = [], []
        for p in fresh:
            raw = p.encode()
            if (r := self.ranks.get(raw)) is not None:
                self.encoded[p] = r.to_bytes(4, "little")
            else:
                unmerged.append(p)
                raws.append(raw)
        for at in range(0, len(raws), 100_000):
            some = raws[at:at + 100_000]
            ends = np.zeros(len(some) + 1, dtype=np.int32)
            np.cumsum([len(r) for r in some], out=ends[1:])
            start = pa.ListArray.from_arrays(pa.array(ends), pa.array(self.byte_id[np.frombuffer(b"".join(some), np.uint8)]))
            self.encoded.update(zip(unmerged[at:at + 100_000], _flat(self._query(_ENCODE, "w", start))))

    def _ids(self, parts: list[list[str]]) -> list[bytes]:
        met = set().union(*parts)
        fresh = [p for p in met if p not in self.encoded]
        if len(self.encoded) + len(fresh) > self.limit:
            self.encoded.clear()
            fresh = list(met)
        if fresh:
            self._learn(fresh)
        return [b"".join(map(self.encoded.__getitem__, part)) for part in parts]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian int32."""
        if sum(len(t or "") for t in texts) > _TOGETHER:  # a very long text goes slice by slice
            return [b"".join(self._ids([part])[0] for part in pieces(t or "", self.pattern)) for t in texts]
        cut = [list(pieces(t or "", self.pattern)) for t in texts]
        ids = iter(self._ids([part for parts in cut for part in parts]))
        return [b"".join(next(ids) for _ in parts) for parts in cut]

    def _places(self, ids: np.ndarray) -> np.ndarray:
        """Where each id is in the vocabulary's list, from 1; 0 for others."""
        if not len(self.known):
            return np.zeros(len(ids), np.int32)
        at = np.minimum(np.searchsorted(self.known, ids), len(self.known) - 1)
        return np.where(self.known[at] == ids, at + 1, 0).astype(np.int32)

    def decode(self, rows: list[bytes]) -> list[bytes]:
        """The bytes of each row of ids (little-endian int32); long rows go chunk by chunk."""
        chunks, owner = [], []
        for i, ids in enumerate(rows):
            for at in range(0, len(ids), _CHUNK):
                chunks.append(ids[at:at + _CHUNK])
                owner.append(i)
        out: list[list[bytes]] = [[] for _ in rows]
        sizes = np.cumsum([0, *map(len, chunks)])
        at = 0
        while at < len(chunks):  # as many chunks at once as hold a bounded number of ids
            stop = max(at + 1, int(np.searchsorted(sizes, sizes[at] + 8 * _CHUNK, "right")) - 1)
            found = self._query(_DECODE, "s", _lists(chunks[at:stop], self._places)).to_pylist()
            for i, part in zip(owner[at:stop], found, strict=True):
                out[i].append(part)
            at = stop
        return [b"".join(parts) for parts in out]


def _slices(column: pa.Array, limit: int = 1 << 22) -> Iterator[tuple[int, list]]:
    """Values in runs of about ``limit`` bytes: (first row, values)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield at, column.slice(at, stop - at).to_pylist()
        at = stop


def _vocabulary(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def roundtrip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
              pattern: str = PATTERN, cache_entries: int = 300_000) -> DataFrame:
    """(``id_col``, ids array<int>, decoded binary) per row of ``docs``: the text's ids, and
    the bytes that these ids decode to."""
    data = _vocabulary(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(data.value, pattern, cache_entries)
        for b in batches:
            for at, texts in _slices(b.column(1)):
                ids = codec.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), _lists(ids), pa.array(codec.decode(ids), pa.binary())],
                    names=[id_col, "ids", "decoded"])

    return _mapped(docs, id_col, text_col, run, "ids array<int>, decoded binary")


def digests(coded: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and (n_tokens, ids_sha256, decoded_sha256) of what ``roundtrip`` returns."""
    return coded.select(*columns, F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           pattern: str = PATTERN, cache_entries: int = 300_000) -> DataFrame:
    """(``id_col``, ids array<int>) per row of ``docs``."""
    data = _vocabulary(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(data.value, pattern, cache_entries)
        for b in batches:
            for at, texts in _slices(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), _lists(codec.encode(texts))],
                                                 names=[id_col, "ids"])

    return _mapped(docs, id_col, text_col, run, "ids array<int>")


def decode(coded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(``id_col``, decoded binary) per row of ids."""
    data = _vocabulary(coded, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(data.value)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                rows = [np.array(x or [], dtype="<i4").tobytes() for x in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(codec.decode(rows), pa.binary())],
                                                 names=[id_col, "decoded"])

    id_type = coded.schema[id_col].dataType.simpleString()
    return map_arrow(coded.select(id_col, F.col(ids_col).cast("array<int>")), run, f"`{id_col}` {id_type}, decoded binary")


def _mapped(docs: DataFrame, id_col: str, text_col: str, run, result: str) -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(id_col, F.col(text_col).cast("string")), run, f"`{id_col}` {id_type}, {result}")
