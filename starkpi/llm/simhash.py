"""SimHash near-dedup with BK-trees.

Fingerprint: ASCII-lower-cased words, shingles of ``shingle`` words with repeats, XXH64
(seed 42) of each, majority vote per bit.  Texts of fewer words give one shingle, texts
without words (empty, NULL, only white space) fingerprint 0, linked like any other.

Links are all pairs of fingerprints that differ in at most ``radius`` bits.  Equal
fingerprints collapse to one row first, however many documents share them.  The 64 bits
are cut into blocks such that fingerprints within the radius agree on at least one choice
of blocks (pigeonhole, exact); each value of such a choice is a *shard*.  A shard's
fingerprints form a BK-tree: a node's children are keyed by their integer Hamming distance
to it, and a search follows only the edges whose distance lies within the radius of the
distance just measured.  A shard beyond ``tree_limit`` nodes becomes several trees, dealt
over tasks; its fingerprints search all of them, so nothing is capped or missed.

Trees travel to their tasks by shuffle.  A broadcast of all shard trees would take every
fingerprint through the driver and grows with the corpus; only a shard's own searchers
ever need its tree.

Numpy works per task on a bounded number of shards at once (whole forests, level by
level); it returns each tree's links as a spanning star, so a dense shard yields at most
one row per fingerprint and tree, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starkpi.llm.common import components, map_arrow, materialize, smallest_of

_BATCH_ROWS = 1 << 17


# ---- fingerprints -----------------------------------------------------------


def text_fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode().lower().split()  # bytes: exactly A-Z, and ASCII white space
    if not words:
        return 0
    parts = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    h = np.fromiter((digest(join(p), 42) for p in parts), dtype="<u8")
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):  # bounded scratch space for very long texts
        votes += np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8),
                               axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """(``id_col``, fp long) per row of ``docs``; fp holds the 64 bits as a signed long.
    Other columns are not read; repeated rows and NULL ids stay as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((text_fingerprint(t, shingle) for t in map(pa.StringScalar.as_py, b.column(1))),
                             dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=[id_col, "fp"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(id_col, F.col(text_col).cast("string")), run, f"`{id_col}` {id_type}, fp long")


def hex_fingerprint(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# ---- shards -----------------------------------------------------------------


def block_count(rows: int, radius: int) -> int:
    """Blocks to cut 64 bits into: with m blocks, fingerprints within the radius agree on
    m - radius of them, a key of about 64 (m - radius) / m bits.  The fewest blocks whose
    key space is as large as the number of rows; the links are the same for any choice."""
    m = radius + 1
    while m < radius + 4 and 64 * (m - radius) / m < np.log2(max(rows, 2)) - 2:
        m += 1
    return m


def shard_keys(radius: int, blocks: int) -> list[tuple[int, int]]:
    """(number, bit mask) for every choice of ``blocks - radius`` blocks."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    keys = [sum(masks[i] for i in pick) for pick in combinations(range(blocks), blocks - radius)]
    assert len(keys) == comb(blocks, radius)
    return [(n, k - (1 << 64) if k >> 63 else k) for n, k in enumerate(keys)]


# ---- BK-forests ---------------------------------------------------------------


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).astype(np.int64)


def build_forest(fp: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees over ``fp`` (uint64, distinct within a tree), one per value of ``tree``
    (0, 1, ... without gaps).  Returns (roots by tree, edge keys sorted, child of each
    key); an edge key is node * 65 + distance.  All trees grow one level at a time: of the
    points that stand at the same node with the same distance the first becomes the child,
    the others move down to it."""
    n = len(fp)
    _, roots = np.unique(tree, return_index=True)
    at = roots[tree]
    left = np.flatnonzero(at != np.arange(n))
    keys, kids = [], []
    while len(left):
        k = at[left] * 65 + _distance(fp[left], fp[at[left]])
        key, first, inverse = np.unique(k, return_index=True, return_inverse=True)
        child = left[first]
        keys.append(key)
        kids.append(child)
        at[left] = child[inverse]
        left = left[at[left] != left]
    if not keys:
        return roots, np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, kids = np.concatenate(keys), np.concatenate(kids)
    order = np.argsort(keys)
    return roots, keys[order], kids[order]


def search_forest(fp: np.ndarray, forest: tuple, query: np.ndarray, tree: np.ndarray,
                  radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yields (query numbers, node numbers) of pairs within ``radius``; each query walks
    its ``tree``, following only edges within the radius of the distance at the node."""
    roots, keys, kids = forest
    for lo in range(0, len(query), 1 << 14):  # bounds the frontier
        q = np.arange(lo, min(len(query), lo + (1 << 14)))
        node = roots[tree[q]]
        while len(q):
            d = _distance(query[q], fp[node])
            hit = d <= radius
            if hit.any():
                yield q[hit], node[hit]
            start = np.searchsorted(keys, node * 65 + np.maximum(d - radius, 0), "left")
            stop = np.searchsorted(keys, node * 65 + np.minimum(d + radius, 64), "right")
            count = stop - start
            q = np.repeat(q, count)
            # numbers start..stop of every range, one after the other
            node = kids[np.arange(len(q)) - np.repeat(np.cumsum(count) - count - start, count)]


def _link_shards(shard: np.ndarray, fp: np.ndarray, is_node: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (fp, fp) of the trees in a batch of whole shards."""
    _, tree = np.unique(shard, return_inverse=True)
    nodes = np.flatnonzero(is_node)
    # a tree may have searchers but, by the deal, no node
    has = np.zeros(tree.max() + 1, dtype=bool)
    has[tree[nodes]] = True
    number = np.cumsum(has) - 1
    seekers = np.flatnonzero(has[tree])
    forest = build_forest(fp[nodes], number[tree[nodes]])
    root = np.arange(len(fp))
    pend_a, pend_b, held = [], [], 0

    def fold():
        nonlocal root, held
        a, b = np.concatenate(pend_a), np.concatenate(pend_b)
        root = smallest_of(len(fp), np.concatenate([a, np.arange(len(fp))]), np.concatenate([b, root]))
        pend_a.clear()
        pend_b.clear()
        held = 0

    for q, node in search_forest(fp[nodes], forest, fp[seekers], number[tree[seekers]], radius):
        a, b = seekers[q], nodes[node]
        new = root[a] != root[b]
        pend_a.append(a[new])
        pend_b.append(b[new])
        held += int(new.sum())
        if held > 1 << 20:
            fold()
    if held:
        fold()
    # the same fingerprint may stand in several rows of a batch; links among them fall away below
    out = np.flatnonzero(fp != fp[root])
    return fp[out], fp[root[out]]


def _search(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> pa.RecordBatch:
            shard = table.column("shard").to_numpy()
            fp = table.column("fp").to_numpy().view(np.uint64)
            node = table.column("node").to_numpy(zero_copy_only=False)
            a, b = _link_shards(shard, fp, node, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) < _BATCH_ROWS:
                continue
            table = pa.Table.from_batches(held)
            shard = table.column("shard").to_numpy()
            cut = int(np.flatnonzero(shard != shard[-1])[-1]) + 1 if (shard != shard[-1]).any() else 0
            if cut:  # rows come sorted by shard: the last one may go on in the next batch
                yield flush(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield flush(pa.Table.from_batches(held))
    return run


def link_fingerprints(fps: DataFrame, radius: int = 3, tree_limit: int = 2048) -> DataFrame:
    """Links (a, b) that connect exactly what pairs of distinct fingerprints within
    ``radius`` bits connect.  ``fps`` has one column, fp, of distinct longs; it is read more
    than once, so pass a materialized frame."""
    rows = fps.count()
    keys = shard_keys(radius, block_count(rows, radius))
    cut = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(mask).alias("mask"))
                                               for n, mask in keys])).alias("k"))
    cut = cut.select("fp", F.xxhash64("k.n", F.col("fp").bitwiseAND(F.col("k.mask"))).alias("key"))
    # two shards whose hashes clash would only share a tree: distances are always measured
    crowded = materialize(cut.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
                          .where(F.col("members") > tree_limit))
    dealt = cut.select(F.col("key").alias("shard"), "fp", F.lit(True).alias("node"))
    if not crowded.isEmpty():
        trees = F.ceil(F.col("members") / tree_limit).cast("int")
        big = cut.join(crowded, "key").select(
            "key", "fp", F.pmod(F.xxhash64("fp"), trees).alias("own"),
            F.explode(F.sequence(F.lit(0), trees - 1)).alias("t"))
        big = big.select(F.xxhash64("key", "t").alias("shard"), "fp", (F.col("own") == F.col("t")).alias("node"))
        dealt = cut.join(crowded, "key", "left_anti").select(
            F.col("key").alias("shard"), "fp", F.lit(True).alias("node")).unionByName(big)
    dealt = dealt.repartition("shard").sortWithinPartitions("shard")
    return map_arrow(dealt, _search(radius), "a long, b long")


def _labels(fp: DataFrame, id_col: str, radius: int) -> DataFrame:
    """(label_fp, root, component_id) per distinct fingerprint of ``fp`` (id_col, fp)."""
    smallest = materialize(fp.groupBy("fp").agg(F.min(id_col).alias("low")))
    nodes = components(link_fingerprints(smallest.select("fp"), radius))
    node_root = nodes.select(F.col("node").alias("fp"), "root")
    rooted = smallest.join(node_root, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    # checkpointed, so that the join to the documents has a shuffle of its own on both
    # sides and AQE can split a fingerprint that a third of all documents share
    return materialize(rooted.join(lows, "root").select(F.col("fp").alias("label_fp"), "root", "component_id"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 3) -> DataFrame:
    """(``id_col``, fp, component_id) per row of ``docs``: component_id is the smallest
    ``id_col`` among all rows reachable over links of at most ``radius`` bits, the row
    itself included.  NULL ids never become a component_id unless the whole component has
    none; an empty table gives an empty result; repeated rows stay, each with its result."""
    fp = materialize(fingerprints(docs, id_col, text_col, shingle))
    label = _labels(fp, id_col, radius)
    return fp.join(label, F.col("fp") == F.col("label_fp")).select(id_col, "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs``, all columns, with one row per component: that with the smallest id.  Rows that
    share an id are told apart by their components: each keeps one row of the id where it is
    its smallest.  Of several such rows in one component, and of the rows of a component
    without any id, the one with the smallest text stays (NULL first, then by a hash of the
    row).  Columns travel in a struct, so that their names clash with nothing."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    fp = materialize(fingerprints(rows, "id", "text", shingle))
    label = _labels(fp, "id", radius)
    first = label.where(F.col("component_id").isNotNull()).select(F.col("component_id").alias("id")).distinct()
    twice = materialize(fp.where(F.col("id").isNotNull()).groupBy("id").count().where("count > 1").select("id"))
    kept, again = rows.join(first, "id", "left_semi"), None
    if not twice.isEmpty():  # the texts move for these rows only
        kept, again = kept.join(twice, "id", "left_anti"), rows.join(twice, "id", "left_semi")
    if not fp.where(F.col("id").isNull()).isEmpty():
        bare = rows.where(F.col("id").isNull())
        again = bare if again is None else again.unionByName(bare)
    if again is not None:
        again = _with_fingerprint(again, shingle).join(label, F.col("fp") == F.col("label_fp"))
        one = Window.partitionBy("root", "id").orderBy(F.col("text").asc_nulls_first(), F.xxhash64("doc"))
        again = again.where(F.col("id").eqNullSafe(F.col("component_id"))).withColumn("n", F.row_number().over(one)).where("n = 1")
        kept = kept.select("doc").unionByName(again.select("doc"))
    return kept.select("doc.*")


def _with_fingerprint(rows: DataFrame, shingle: int) -> DataFrame:
    """(id, text, doc) plus fp."""
    def run(batches):
        for b in batches:
            fp = np.array([text_fingerprint(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp.view(np.int64))], names=[*b.schema.names, "fp"])
    return map_arrow(rows, run, StructType([*rows.schema.fields, StructField("fp", LongType())]))
