"""Embedding near-dedup by sorted projection passes.

Every pass hashes each vector to the signs of 64 random projections, joined to one key, and
orders the vectors by it; each is compared with its ``window`` neighbours in that order.
Pairs whose cosine (double precision) reaches the threshold are links; the links of all
passes are united to components.  A pair stays unseen only if every pass sets it apart.
How likely that is depends on how crowded a vector's surroundings are, and is measured: a
window reaches all vectors that share more leading signs with a vector than those a window
away do, and a pair at the threshold shares them with a known probability.  A vector is
settled when its passes together miss such a pair with a probability below 1 - ``recall``
(closer pairs far less often).  A pair with one settled end has its probability already, so
settled vectors need not go on.  Of those that are not, groups of near duplicates are taken
out first (``crowds``): the members of a component that link with one of them, its pivot, are
connected by that alone, however many they are, and are compared only with what the triangle
inequality of angles lets them link with outside their component.  The others go on by
themselves, in further passes or, where that is less work, compared with each other block by
block, which misses none.  ``pass_count`` plans the passes for evenly spread vectors; a round
makes at most ``PASSES_AT_A_TIME`` of them, which bounds its shuffled copies, not their number.
A dense region of m vectors that are no near duplicates costs m * m / 2 comparisons, made by
matrix products.

The windows are bounded; what they leave out within a component is made up for exactly, so
that link counts are whole.  Vectors within half the threshold's angle of a component's
pivot are all linked with each other (triangle inequality of angles), which counts a dense
group of any size without comparing its pairs.  The rest of a component, its fringe, is
compared with all its members, block by block, and yields counts, not pairs.

Equal vectors are one class from the start and count with their number.  Vectors that are
NULL, zero, or hold NULL or non-finite components link with nothing and are components of
their own; vectors of different lengths never link.  Rows that repeat an id count as
vectors of their own, and each has its result.  An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from starkpi.llm.common import components, map_arrow, materialize, smallest_of

# Above this cosine of half the threshold's angle a pair counts as inside the core; the
# margin keeps rounding from calling a pair a link that direct comparison would not.
_MARGIN = 1e-9


def pass_count(rows: int, threshold: float, window: int, recall: float = 0.98) -> int:
    """Passes after which a pair right at the threshold has met with probability ``recall``:
    neighbours within the window share about log2(rows / window) leading signs, and one
    sign agrees with probability 1 - angle / pi."""
    agree = 1 - math.acos(threshold) / math.pi
    meet = agree ** max(1.0, math.log2(max(rows, 2) / window))
    return max(4, math.ceil(math.log(1 - recall) / math.log1p(-meet)))


# Copies of the vectors that one round shuffles; rounds follow until the recall holds.
PASSES_AT_A_TIME = 64
# Comparisons of a matrix product in the time of one between shifted rows.
_PRODUCT_GAIN = 8
# A certain meeting, as -log of the chance to miss.
_CERTAIN = 1e3


def _leading(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading bits two arrays of 64-bit keys share."""
    x = (a ^ b).view(np.uint64)
    high, low = (x >> np.uint64(32)).astype(np.float64), (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return 64 - np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1])


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vector: Column) -> Column:
    """Whether a vector can link: no NULL or non-finite component, and not all are zero."""
    x = vector.cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(x.isNotNull() & ~odd & F.exists(x, lambda v: v != 0), F.lit(False))


def classes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec, dim, node, copies) per distinct usable vector; node is a 64-bit number that
    stands for it."""
    x = F.transform(F.col(vector_col).cast("array<double>"), lambda v: v + 0.0)  # one zero only
    rows = vectors.where(usable(F.col(vector_col))).select(x.alias("vec"))
    return rows.groupBy("vec").agg(F.count(F.lit(1)).alias("copies")).select(
        "vec", F.size("vec").alias("dim"), F.xxhash64("vec").alias("node"), "copies")


# ---- sorted projection passes -----------------------------------------------


def keyed(nodes: DataFrame, passes: int, seed: int) -> DataFrame:
    """(dim, pass, key, node, vec): every vector once per pass with its sort key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims):
                some = b.filter(pa.array(dims == dim))
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).normal(size=(int(dim), passes, 64))
                signs = np.einsum("nd,dpk->npk", _matrix(some.column(0)), planes[dim], optimize=True) > 0
                keys = np.ascontiguousarray(np.packbits(signs, axis=2)).view(">u8")[:, :, 0].astype(np.uint64)
                keys = (keys ^ np.uint64(1 << 63)).view(np.int64)  # signed order is unsigned order
                for p in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [some.column(1), pa.array(np.full(some.num_rows, p, np.int32)), pa.array(keys[:, p]),
                         some.column(2), some.column(0)], names=["dim", "pass", "key", "node", "vec"])

    return map_arrow(nodes.select("vec", "dim", "node"), run, "dim int, pass int, key long, node long, vec array<double>")


def _neighbours(x: np.ndarray, group: np.ndarray, window: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (earlier, later row) at most ``window`` apart, of one group, at the threshold."""
    for step in range(1, min(window, len(x) - 1) + 1):
        close = np.einsum("nd,nd->n", x[:-step], x[step:]) >= threshold
        close &= group[:-step] == group[step:]
        at = np.flatnonzero(close)
        yield at, at + step


def window_links(sorted_rows: DataFrame, window: int, threshold: float, parts: int) -> DataFrame:
    """(a, b) links that connect what the pairs found connect; with ``border`` the rows at
    the ends of each of the ``parts`` partitions; with ``seen`` nodes and what a pass is worth
    to each: -log of the chance that it misses a partner right at the threshold.

    A partition compares its own neighbours; its first and last ``window`` rows go on to be
    compared across the border with those of the next partition."""
    schema = ("a long, b long, border int, side int, place int, dim int, pass int, vec array<double>, "
              "seen array<long>, worth array<double>")
    agree = 1 - math.acos(threshold) / math.pi
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: pa.RecordBatch | None = None
        valued = 0  # rows held whose worth is out already

        def ends(rows: pa.RecordBatch, border: int, side: int) -> pa.RecordBatch:
            n = rows.num_rows
            return pa.RecordBatch.from_arrays(
                [rows.column(3), pa.nulls(n, pa.int64()), pa.array(np.full(n, border, np.int32)),
                 pa.array(np.full(n, side, np.int32)), pa.array(np.arange(n, dtype=np.int32)),
                 rows.column(0), rows.column(1), rows.column(4), pa.nulls(n, pa.list_(pa.int64())),
                 pa.nulls(n, pa.list_(pa.float64()))], names=names)

        def worth(rows: pa.RecordBatch, start: int, stop: int) -> Iterator[pa.RecordBatch]:
            """Of rows start to stop; where the row a window away lies beyond the partition
            the pass is worth nothing, where the group ends before it, it is certain."""
            at = np.arange(start, stop)
            if not len(at):
                return
            key, n = rows.column(2).to_numpy(), rows.num_rows
            group = rows.column(0).to_numpy().astype(np.int64) << 32 | rows.column(1).to_numpy()
            shared = np.full(len(at), -1)
            for away, last in ((at - window, part == 0), (at + window, part == parts - 1)):
                there = np.clip(away, 0, n - 1)
                inner = np.where(there == away, _leading(key[at], key[there]), -1 if last else 64)
                shared = np.maximum(shared, np.where(group[at] == group[there], inner, -1))
            miss = 1 - agree ** (shared + 1.0)
            value = np.where(shared >= 64, 0.0, -np.log(np.maximum(miss, math.exp(-_CERTAIN))))
            node = rows.column(3).to_numpy()[at]
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), *(pa.int32(),) * 5, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*none, pa.array([node], pa.list_(pa.int64())), pa.array([value], pa.list_(pa.float64()))],
                                             names=names)

        def pairs(rows: pa.RecordBatch, fresh_from: int) -> Iterator[pa.RecordBatch]:
            dims, node = rows.column(0).to_numpy(), rows.column(3).to_numpy()
            group = dims.astype(np.int64) << 32 | rows.column(1).to_numpy()
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                x = _unit(_matrix(rows.column(4).take(pa.array(own))))
                found = [(own[i], own[j]) for i, j in _neighbours(x, group[own], window, threshold)]
                if not found:
                    continue
                i, j = (np.concatenate(z) for z in zip(*found))
                i, j = i[j >= fresh_from], j[j >= fresh_from]
                # a spanning star connects what the pairs connect, with a row per vector at most
                root = smallest_of(len(node), i, j)
                i = np.flatnonzero(root != np.arange(len(node)))
                n = len(i)
                none = [pa.nulls(n, t) for t in (*(pa.int32(),) * 5, *map(pa.list_, (pa.float64(), pa.int64(), pa.float64())))]
                yield pa.RecordBatch.from_arrays([pa.array(node[i]), pa.array(node[root[i]]), *none], names=names)

        opening: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                rows = batch.slice(at, 4096)
                if sum(o.num_rows for o in opening) < window:
                    opening.append(rows.slice(0, window - sum(o.num_rows for o in opening)))
                old = held.num_rows if held is not None else 0
                if old:
                    rows = pa.Table.from_batches([held, rows]).combine_chunks().to_batches()[0]
                yield from pairs(rows, old)
                whole = max(valued, rows.num_rows - window)
                yield from worth(rows, valued, whole)
                held = rows.slice(max(0, rows.num_rows - 2 * window))
                valued = whole - (rows.num_rows - held.num_rows)
        for o in opening:
            yield ends(o, part, 1)
        if held is not None:
            yield from worth(held, valued, held.num_rows)
            yield ends(held.slice(max(0, held.num_rows - window)), part + 1, 0)

    return map_arrow(sorted_rows, run, schema)


def _across(window: int, threshold: float):
    """Links across one border: its last rows before and its first rows after."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table["side"].to_numpy()
        before, after = table.filter(pa.array(side == 0)), table.filter(pa.array(side == 1))
        a, b = [], []
        for dim in np.unique(table["dim"].to_numpy()):
            l, r = (t.filter(pa.array(t["dim"].to_numpy() == dim)) for t in (before, after))
            if not (l.num_rows and r.num_rows):
                continue
            x, y = (_unit(_matrix(t["vec"].combine_chunks())) for t in (l, r))
            # places count from the border: the last row before it stands at 1, the first after at 0
            gap = (len(before) - l["place"].to_numpy())[:, None] + r["place"].to_numpy()[None, :]
            same = l["pass"].to_numpy()[:, None] == r["pass"].to_numpy()[None, :]
            i, j = np.nonzero((x @ y.T >= threshold) & same & (gap <= window))
            a.append(l["a"].to_numpy()[i])
            b.append(r["a"].to_numpy()[j])
        empty = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([empty, *a]), "b": np.concatenate([empty, *b])})
    return run


def pass_links(nodes: DataFrame, count: int, threshold: float, window: int, passes: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Distinct links (a, b) that connect all nodes that meet in some pass, and (node, gained):
    what all passes together are worth to each of the ``count`` nodes.  Windows reach into
    the next partition, not beyond: a partition holds several of them."""
    spark = nodes.sparkSession
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), count * passes // (8 * window)))
    order = ["dim", "pass", "key", "node"]
    rows = keyed(nodes, passes, seed).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = materialize(window_links(rows, window, threshold, parts))
    inner = found.where(F.col("b").isNotNull()).select("a", "b")
    borders = found.where(F.col("border").isNotNull()).drop("seen", "worth")
    across = borders.groupBy("border").applyInArrow(_across(window, threshold), "a long, b long")
    both = inner.unionByName(across)
    links = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    seen = found.where(F.col("seen").isNotNull()).select(F.inline(F.arrays_zip("seen", "worth")).alias("node", "worth"))
    return links, seen.groupBy("node").agg(F.sum("worth").alias("gained"))


def block_links(nodes: DataFrame, rows: int, threshold: float, block: int = 8192) -> DataFrame:
    """Links (a, b) that connect all pairs of ``nodes`` at the threshold: every block of them
    against every other."""
    blocks = -(-rows // block)
    own = F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")
    dealt = nodes.select("node", "dim", "vec", own.alias("own"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other"))
    dealt = dealt.select("node", "dim", "vec", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        own, node = table["own"].to_numpy(), table["node"].to_numpy()
        left, right = (np.flatnonzero(own == table[c][0].as_py()) for c in ("i", "j"))
        x = _unit(_matrix(table["vec"].combine_chunks()))
        y = x[right]
        stars = []
        for at in range(0, len(left), 1024):
            some = left[at:at + 1024]
            a, b = np.nonzero(x[some] @ y.T >= threshold)
            root = smallest_of(len(node), some[a], right[b])
            hung = np.flatnonzero(root != np.arange(len(node)))
            stars.append((hung, root[hung]))
        a, b = (np.concatenate([np.zeros(0, np.int64), *z]) for z in (zip(*stars) if stars else ((), ())))
        root = smallest_of(len(node), a, b)
        hung = np.flatnonzero(root != np.arange(len(node)))
        return pa.table({"a": node[hung], "b": node[root[hung]]})

    return dealt.groupBy("dim", "i", "j").applyInArrow(compare, "a long, b long")


# ---- groups of near duplicates ----------------------------------------------


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def crowds(rest: DataFrame, links: DataFrame, threshold: float, least: int) -> DataFrame:
    """``rest`` with (root, pivot, angle): a vector that ``links`` connect it with, and of
    a group of ``least`` vectors or more of one root that all link with one of them, that
    one's node and the angle to it; NULL for the others.  The root is the smallest
    vector two links away, and the one two links from that: few to a component, without all
    its rounds.  A root may hold several groups: those that do not link with its first pivot choose
    another, until two turns took in few of them."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy(F.col("u").alias("__k")).agg(F.min("v").alias("__v")).select("__k", F.least("__k", "__v").alias("__low"))
    low = materialize(both.join(low, F.col("v") == F.col("__k")).groupBy("u").agg(F.min("__low").alias("v")))
    roots = low.join(low.select(F.col("u").alias("__u"), F.col("v").alias("root")), F.col("v") == F.col("__u")).select(
        F.col("u").alias("__n"), "root")
    left = materialize(rest.join(roots, F.col("node") == F.col("__n"), "left").drop("__n"))
    out, count = None, left.count()
    none = {"pivot": F.lit(None).cast("long"), "angle": F.lit(None).cast("double")}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, vec, pivot = (b.schema.get_field_index(c) for c in ("dim", "vec", "__vec"))
            dims, cosine = b.column(at).to_numpy(), np.zeros(b.num_rows)
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                x, y = (_unit(_matrix(b.column(c).take(pa.array(own)))) for c in (vec, pivot))
                cosine[own] = np.einsum("nd,nd->n", x, y)
            linked = (cosine >= threshold) | (b.column(b.schema.get_field_index("node")).to_numpy()
                                              == b.column(b.schema.get_field_index("__pivot")).to_numpy())
            # rounding must not narrow an angle
            yield b.append_column("angle", pa.array(_angle(cosine - _MARGIN), mask=~linked))

    turn, idle = 0, 0
    while count and idle < 2:
        rank = F.xxhash64("node", F.lit(turn))
        first = left.where(F.col("root").isNotNull()).groupBy(F.col("root").alias("__root")).agg(
            F.min(rank).alias("__rank"), F.count(F.lit(1)).alias("__size"))
        first = first.where(F.col("__size") >= least)
        chosen = materialize(left.join(first, (F.col("root") == F.col("__root")) & (rank == F.col("__rank"))).select(
            "__root", F.col("node").alias("__pivot"), F.col("vec").alias("__vec")))
        if chosen.isEmpty():
            break
        tried = left.join(chosen, F.col("root") == F.col("__root"))
        placed = materialize(map_arrow(tried, place, StructType([*tried.schema, StructField("angle", DoubleType())])))
        sizes = placed.where(F.col("angle").isNotNull()).groupBy(F.col("__pivot").alias("__p")).agg(F.count(F.lit(1)).alias("__size"))
        sizes = sizes.where(F.col("__size") >= least)
        taken = materialize(placed.where(F.col("angle").isNotNull()).join(sizes, F.col("__pivot") == F.col("__p")).select(
            *left.columns, F.col("__pivot").alias("pivot"), "angle"))
        out = taken if out is None else out.unionByName(taken)
        left = materialize(left.join(taken.select(F.col("node").alias("__n")), F.col("node") == F.col("__n"), "left_anti"))
        before, count, turn = count, left.count(), turn + 1
        idle = idle + 1 if count > 0.9 * before else 0
    left = left.withColumns(none)
    return left if out is None else out.unionByName(left)


def _stars(node: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows a and b as a spanning star of nodes: a row per node at most."""
    empty = np.zeros(0, np.int64)
    root = smallest_of(len(node), np.concatenate([empty, *a]), np.concatenate([empty, *b]))
    hung = np.flatnonzero(root != np.arange(len(node)))
    return node[hung], node[root[hung]]


def crowd_links(placed: DataFrame, known: DataFrame, threshold: float, block: int = 4096) -> DataFrame:
    """Links (a, b) that connect every vector of a group with its pivot, and groups with all of
    ``placed`` that links with a member of theirs, but for what the ``known`` links connect.

    Pivots are compared with the pivots and the ungrouped vectors of other roots, block by
    block.  Where the angle exceeds the threshold's by no more than the groups' radii,
    members may link all the same: those groups are compared member by member, in blocks."""
    limit = math.acos(threshold)
    inner = placed.where(F.col("pivot").isNotNull()).select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    radii = placed.where(F.col("pivot").isNotNull()).groupBy(F.col("pivot").alias("__p")).agg(F.max("angle").alias("radius"))
    heads = placed.join(radii, F.col("node") == F.col("__p")).select("node", "root", "dim", "vec", "radius")
    alone = placed.where(F.col("pivot").isNull()).select("node", "root", "dim", "vec", F.lit(0.0).alias("radius"))
    points = materialize(heads.withColumn("head", F.lit(True)).unionByName(alone.withColumn("head", F.lit(False))))
    n, k = points.agg(F.count(F.lit(1)), F.count(F.when(F.col("head"), 1))).first()
    point_blocks, head_blocks = -(-n // block), -(-k // block)
    columns = ["node", "root", "dim", "vec", "radius", "head"]
    asks = points.select(*columns, F.lit(True).alias("asks"), F.pmod(F.xxhash64("node"), F.lit(point_blocks)).alias("i"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(head_blocks - 1).cast("long"))).alias("j"))
    told = points.where("head").select(
        *columns, F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(point_blocks - 1).cast("long"))).alias("i"),
        F.pmod(F.xxhash64("node"), F.lit(head_blocks)).alias("j"))

    def near(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table["asks"].to_numpy(zero_copy_only=False)
        q, p = table.filter(pa.array(side)), table.filter(pa.array(~side))
        parts = []
        if q.num_rows and p.num_rows:
            y, yn = _unit(_matrix(p["vec"].combine_chunks())), p["node"].to_numpy()
            yr, reach = p["root"].to_numpy(), p["radius"].to_numpy()
            for at in range(0, q.num_rows, 1024):
                some = q.slice(at, 1024).combine_chunks()
                x, xn, head = (_unit(_matrix(some["vec"].combine_chunks())), some["node"].to_numpy(),
                               some["head"].to_numpy(zero_copy_only=False))
                xr = some["root"].fill_null(0).to_numpy()
                apart = (xr[:, None] != yr[None, :]) | some["root"].is_null().to_numpy()[:, None]
                # two heads meet from both sides: the greater node asks
                apart &= ~head[:, None] | (xn[:, None] > yn[None, :])
                cosine = x @ y.T
                i, j = np.nonzero(apart & (_angle(cosine + _MARGIN) <= limit + some["radius"].to_numpy()[:, None] + reach[None, :]))
                parts.append(pa.table({"a": xn[i], "b": yn[j], "head": head[i], "linked": cosine[i, j] >= threshold}))
        empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()),
                          "head": pa.array([], pa.bool_()), "linked": pa.array([], pa.bool_())})
        return pa.concat_tables([empty, *parts])

    met = materialize(asks.unionByName(told).groupBy("dim", "i", "j").applyInArrow(near, "a long, b long, head boolean, linked boolean"))
    links = inner.unionByName(met.where("linked").select("a", "b"))
    open_pairs = met.where("not linked")
    if open_pairs.isEmpty():
        return links
    # pairs of groups that the links so far connect need no comparison
    joined = materialize(components(links.unionByName(known.select("a", "b"))))
    for end in ("a", "b"):
        one = joined.select(F.col("node").alias("__" + end), F.col("root").alias("root_" + end))
        open_pairs = open_pairs.join(one, F.col(end) == F.col("__" + end), "left")
    open_pairs = open_pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b", "head")
    open_pairs = materialize(open_pairs)
    members = placed.where(F.col("pivot").isNotNull()).select(F.col("pivot").alias("__m"), "node", "vec")
    single = placed.where(F.col("pivot").isNull()).select(F.col("node").alias("__m"), "node", "vec")
    # single vectors that meet one group are one side of one comparison: (group, group)
    left = open_pairs.where("head").join(members, F.col("a") == F.col("__m")).select("a", "b", "node", "vec").unionByName(
        open_pairs.where("not head").join(single, F.col("a") == F.col("__m")).select(F.col("b").alias("a"), "b", "node", "vec"))
    right = open_pairs.select(F.when(F.col("head"), F.col("a")).otherwise(F.col("b")).alias("a"), "b").distinct().join(
        members, F.col("b") == F.col("__m")).select("a", "b", "node", "vec")
    dealt = materialize(left.withColumn("asks", F.lit(True)).unionByName(right.withColumn("asks", F.lit(False))))
    sizes = dealt.groupBy(F.col("a").alias("__a"), F.col("b").alias("__b")).agg(
        F.ceil(F.count(F.when(F.col("asks"), 1)) / block).alias("lefts"), F.ceil(F.count(F.when(~F.col("asks"), 1)) / block).alias("rights"))
    dealt = dealt.join(sizes, (F.col("a") == F.col("__a")) & (F.col("b") == F.col("__b")))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("asks"), F.col("lefts")).otherwise(F.col("rights")))
    others = F.sequence(F.lit(0).cast("long"), F.when(F.col("asks"), F.col("rights")).otherwise(F.col("lefts")) - 1)
    dealt = dealt.select("a", "b", "node", "vec", "asks", own.alias("own"), F.explode(others).alias("other")).select(
        "a", "b", "node", "vec", "asks", F.when(F.col("asks"), F.col("own")).otherwise(F.col("other")).alias("i"),
        F.when(F.col("asks"), F.col("other")).otherwise(F.col("own")).alias("j"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table["asks"].to_numpy(zero_copy_only=False)
        node, rows = table["node"].to_numpy(), np.flatnonzero(side)
        right = np.flatnonzero(~side)
        x, a, b = _unit(_matrix(table["vec"].combine_chunks())), [], []
        for at in range(0, len(rows), 1024):
            some = rows[at:at + 1024]
            i, j = np.nonzero(x[some] @ x[right].T >= threshold)
            # one partner and one group of partners connect as much as all pairs do
            u, v = _stars(np.arange(len(node)), [some[i]], [right[j]])
            a.append(u)
            b.append(v)
        u, v = _stars(node, a, b)
        return pa.table({"a": u, "b": v})

    return links.unionByName(dealt.groupBy("a", "b", "i", "j").applyInArrow(compare, "a long, b long").select("a", "b"))


def all_links(nodes: DataFrame, rows: int, threshold: float, window: int, passes: int | None, seed: int,
              recall: float = 0.98) -> DataFrame:
    """Links (a, b) that connect ``nodes``, in rounds until each is settled; with ``passes`` in
    one round of as many, whatever they reach."""
    rest, need = nodes.select("vec", "dim", "node", F.lit(0.0).alias("worth")), -math.log(1 - recall)
    m = rows
    n, rounds = passes or min(PASSES_AT_A_TIME, pass_count(rows, threshold, window)), []

    def leave_crowds(rest: DataFrame, rounds: list[DataFrame]) -> tuple[DataFrame, int]:
        known = functools.reduce(DataFrame.unionByName, rounds)
        placed = materialize(crowds(rest, known, threshold, window))
        if placed.where(F.col("pivot").isNotNull()).isEmpty():
            return rest, rest.count()
        rounds.append(materialize(crowd_links(placed, known, threshold)))
        rest = materialize(placed.where(F.col("pivot").isNull()).select(*rest.columns))
        return rest, rest.count()

    while True:
        links, gains = pass_links(rest, m, threshold, window, n, seed + len(rounds))
        rounds.append(materialize(links))
        if passes:
            break
        left = rest.join(gains.withColumnRenamed("node", "__n"), F.col("node") == F.col("__n"), "left").select(
            "vec", "dim", "node", (F.col("worth") + F.coalesce("gained", F.lit(0.0))).alias("worth"),
            F.greatest(F.coalesce("gained", F.lit(0.0)) / n, F.lit(1e-9)).alias("rate"))
        rest = materialize(left.where(F.col("worth") < need))
        m = rest.count()
        if m and len(rounds) == 1:
            rest, m = leave_crowds(rest, rounds)
        if not m:
            break
        # a vector that no pass helps counts as many as there are vectors left
        wanted = rest.agg(F.sum(F.least((F.lit(need) - F.col("worth")) / F.col("rate"), F.lit(float(m))))).first()[0]
        if m / 2 <= wanted / m * window * _PRODUCT_GAIN:
            rounds.append(materialize(block_links(rest, m, threshold)))
            break
        n = max(1, min(PASSES_AT_A_TIME, math.ceil(wanted / m)))
        rest = rest.drop("rate")
    return functools.reduce(DataFrame.unionByName, rounds)


# ---- whole link counts ------------------------------------------------------


def link_counts(members: DataFrame, threshold: float, block: int = 1024) -> DataFrame:
    """(node, linked): how many vectors each node links with directly, copies counted, its
    own copies left out.  ``members``: (root, node, vec, copies, pivot)."""
    half = math.cos(math.acos(threshold) / 2) + _MARGIN

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            core = np.zeros(b.num_rows, bool)
            lengths = np.array([len(v) for v in b.column(2)])
            for dim in np.unique(lengths):
                own = np.flatnonzero(lengths == dim)
                x, p = (_unit(_matrix(b.column(c).take(pa.array(own)))) for c in (2, 4))
                core[own] = np.einsum("nd,nd->n", x, p) >= half
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(core)],
                                             names=["root", "node", "vec", "copies", "core"])

    placed = materialize(map_arrow(members.select("root", "node", "vec", "copies", "pivot"), place,
                                   "root long, node long, vec array<double>, copies long, core boolean"))
    # every pair of the core is a link: one sum per component
    in_core = placed.where("core").groupBy("root").agg(F.sum("copies").alias("mass"))
    dense = placed.where("core").join(in_core.withColumnRenamed("root", "__r"), F.col("root") == F.col("__r")).select(
        "node", (F.col("mass") - F.col("copies")).alias("linked"))
    sizes = placed.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~F.col("core"), 1)).alias("fringe"))
    sizes = materialize(sizes.where("fringe > 0").withColumnRenamed("root", "__r"))
    if sizes.isEmpty():
        return dense.groupBy("node").agg(F.sum("linked").alias("linked"))
    # the fringe against all members, dealt out as blocks of bounded size
    some = placed.join(sizes, F.col("root") == F.col("__r"))
    member_blocks, fringe_blocks = F.ceil(F.col("n") / block), F.ceil(F.col("fringe") / block)
    columns = ["root", "node", "vec", "copies", "core"]
    left = some.where("not core").select(*columns, F.lit(True).alias("asks"),
                                         F.pmod(F.xxhash64("node"), fringe_blocks).alias("i"),
                                         F.explode(F.sequence(F.lit(0).cast("long"), member_blocks - 1)).alias("j"))
    right = some.select(*columns, F.lit(False).alias("asks"),
                        F.explode(F.sequence(F.lit(0).cast("long"), fringe_blocks - 1)).alias("i"),
                        F.pmod(F.xxhash64("node"), member_blocks).alias("j"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = table["asks"].to_numpy(zero_copy_only=False)
        f, m = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
        nodes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if f.num_rows and m.num_rows:
            x, y = (_unit(_matrix(t["vec"].combine_chunks())) for t in (f, m))
            fn, mn = f["node"].to_numpy(), m["node"].to_numpy()
            hit = (x @ y.T >= threshold) & (fn[:, None] != mn[None, :])
            # a fringe vector counts its links to all; a core vector those to the fringe
            nodes += [fn, mn]
            counts += [hit @ m["copies"].to_numpy(), (hit.T @ f["copies"].to_numpy()) * m["core"].to_numpy(zero_copy_only=False)]
        return pa.table({"node": np.concatenate(nodes), "linked": np.concatenate(counts).astype(np.int64)})

    sparse = left.unionByName(right).groupBy("root", "i", "j").applyInArrow(compare, "node long, linked long")
    return dense.unionByName(sparse).groupBy("node").agg(F.sum("linked").alias("linked"))


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, window: int = 64, passes: int | None = None,
                    seed: int = 42, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(``id_col``, n_links, component_id, kept) per row of ``vectors``: how many other vectors
    it links with directly, the smallest id reachable over links, and whether that is its
    own.  The vectors that stay are those kept."""
    nodes = materialize(classes(vectors, id_col, vector_col))
    rows = nodes.count()
    found = components(all_links(nodes, rows, threshold, window, passes, seed))
    found = materialize(found)
    members = nodes.join(found.withColumnRenamed("node", "__n"), F.col("node") == F.col("__n")).drop("__n")
    # the pivot is the member that the component is named after; its vector goes to all members
    pivot = materialize(nodes.join(found.select(F.col("root").alias("__p")).distinct(), F.col("node") == F.col("__p"))
                        .select(F.col("node").alias("__p"), F.col("vec").alias("pivot")))
    members = members.join(pivot, F.col("root") == F.col("__p")).select("root", "node", "vec", "copies", "pivot")
    linked = link_counts(members, threshold)
    facts = nodes.join(linked.withColumnRenamed("node", "__n"), F.col("node") == F.col("__n"), "left").join(
        found.select(F.col("node").alias("__m"), "root"), F.col("node") == F.col("__m"), "left")
    facts = materialize(facts.select(F.col("node").alias("__node"), F.coalesce("root", "node").alias("root"),
                                     (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    x = F.transform(F.col(vector_col).cast("array<double>"), lambda v: v + 0.0)
    ids = materialize(vectors.select(F.col(id_col).alias("id"), F.when(usable(F.col(vector_col)), F.xxhash64(x)).alias("node")))
    rooted = ids.join(facts, F.col("node") == F.col("__node"), "left")
    lows = materialize(rooted.where(F.col("root").isNotNull()).groupBy(F.col("root").alias("__root")).agg(F.min("id").alias("low")))
    out = rooted.join(lows, F.col("root") == F.col("__root"), "left")
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("low"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
