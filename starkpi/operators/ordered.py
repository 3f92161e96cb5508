"""Global rank and running totals without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.
Here the rows are cut into about ``n_buckets`` ranges of the *full* order key
(which must be unique, so no group of equal keys can pile up in one range).
Range bounds come from a random sample of keys: a bounded array (about
``oversample * n_buckets`` keys are sorted, every so many kept), planned as a
scalar subquery and never collected; for a single numeric key they are its
approximate quantiles (one aggregate).  A bucket is a monotone function of the
key, found by a two-level search of the bounds; per-bucket sums (one row per
bucket, gathered by one aggregate into a small array of prefixes) give each
bucket the sums of all buckets before it, and the window itself runs
partitioned by bucket.  Work per row grows with the square root of the number
of ranges (some hundred bounds at tens of thousands), work per range is constant.  The sample only decides *where* a row
is processed, never its result, so results are exact whatever the sample.

Rank (ties share a rank, the next one is skipped) is computed without
ordering equal values at all: rank(v) = 1 + number of rows with a larger
value.  Rows are counted per distinct value (partial aggregation collapses a
value shared by millions of rows into one row), the running count runs over
those unique values, and the ranks join back on the value.

An exact distributed rank needs its input several times (bounds, bucket
sizes, the ranks).  ``shared`` gives it one shuffle that all uses read: the
columns travel as one value, so Catalyst cannot prune the copies differently
and reuses the exchange; the facts behind it are scanned once.  Everything is
lazy -- no job runs while a plan is built -- so a view over a rank follows its
tables.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

_BUCKET = "__bucket"
_KEY = "__key"


def shared(df: DataFrame) -> DataFrame:
    """``df`` behind a shuffle that every later use of it reads again.  The rows
    are dealt evenly, as one array column that no optimizer rule looks into."""
    packed = df.select(F.array(F.struct(*df.columns)).alias("__row")).repartition(F.col("__row"))
    return packed.select(*[F.col("__row")[0][c].alias(c) for c in df.columns])


def range_count(df: DataFrame) -> int:
    """Ranges of a running total: as many as the session's shuffles have
    partitions, which a deployment sizes by its data (``recommended_conf``)."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _order_key(order: list[tuple[str, bool]]) -> Column:
    """An ascending struct key for ``order`` = [(column, descending?), ...]
    with SQL's default NULL placement (first ascending, last descending);
    descending columns must be numeric (they are negated behind a NULL flag)."""
    fields = []
    for i, (c, desc) in enumerate(order):
        if desc:
            fields += [F.col(c).isNull().alias(f"n{i}"), (-F.col(c)).alias(f"k{i}")]
        else:
            fields.append(F.col(c).alias(f"k{i}"))
    return F.struct(*fields)


def _bucketed(df: DataFrame, order: list[tuple[str, bool]], n_buckets: int,
              oversample: int = 32, seed: int = 17) -> DataFrame:
    """``df`` with its order key and range number."""
    keyed = df.withColumn(_KEY, _order_key(order))
    if len(order) == 1 and isinstance(df.schema[order[0][0]].dataType, NumericType):
        # one numeric key: its approximate quantiles (one aggregate) are the bounds
        k = F.col(f"{_KEY}.k0").cast("double")
        probs = [i / n_buckets for i in range(1, n_buckets)]
        bounds = _in_two_levels(keyed.select(F.percentile_approx(k, probs, max(10_000, 4 * n_buckets)).alias("a")), n_buckets)
        # NULL keys sort last when descending, first when ascending
        null_bucket = _most_ranges(n_buckets) - 1 if order[0][1] else 0
        return keyed.withColumn(_BUCKET, F.when(k.isNull(), F.lit(null_bucket)).otherwise(_bounds_below(bounds, k, n_buckets)))
    n_rows = keyed.select(F.count(F.lit(1))).scalar()
    sample = keyed.filter(F.rand(seed) * n_rows < F.lit(float(n_buckets * oversample)))
    keys = sample.agg(F.sort_array(F.collect_list(_KEY)).alias("a"))
    # every so many-th key, so that there are n_buckets - 1 bounds at most
    step = F.greatest(F.lit(1), F.ceil(F.size("a") / F.lit(n_buckets)).cast("int"))
    bounds = _in_two_levels(keys.select(F.filter("a", lambda x, i: ((i + 1) % step == 0) & (i + 1 < F.size("a"))).alias("a")), n_buckets)
    return keyed.withColumn(_BUCKET, _bounds_below(bounds, F.col(_KEY), n_buckets))


def _in_two_levels(keys: DataFrame, n_buckets: int) -> Column:
    """The sorted bounds ``a`` of a one-row query as (last bound of each chunk, chunks of about
    the square root of their number): what a row searches is two short arrays."""
    width = _chunk(n_buckets)
    places = F.sequence(F.lit(0), F.ceil(F.size("a") / F.lit(width)).cast("int") - 1)
    chunks = F.transform(places, lambda j: F.slice("a", j * width + 1, width))
    return keys.select(F.when(F.size("a") > 0, F.struct(
        F.transform(chunks, lambda c: F.element_at(c, -1)).alias("last"), chunks.alias("chunks")))).scalar()


def _most_ranges(n_buckets: int) -> int:
    """Range numbers are below this: a key above all bounds follows the last whole chunk."""
    return n_buckets + 2 * _chunk(n_buckets)


def _chunk(n_buckets: int) -> int:
    return math.isqrt(n_buckets) + 1


def _bounds_below(bounds: Column, key: Column, n_buckets: int) -> Column:
    """How many bounds are below ``key`` (none: 0): the first place of the key, sorted into
    the chunks' last bounds, names the chunk, and its first place there the bound."""
    def place(a):
        return F.array_position(F.sort_array(F.concat(a, F.array(key))), key) - 1

    chunk = F.coalesce(place(bounds["last"]), F.lit(0)).cast("int")
    return (chunk * _chunk(n_buckets) + F.coalesce(place(F.get(bounds["chunks"], chunk)), F.lit(0))).cast("int")


def running_sums(df: DataFrame, order: list[tuple[str, bool]], sums: dict[str, str],
                 n_buckets: int | None = None) -> DataFrame:
    """For each ``out -> src`` in ``sums`` add the running (inclusive) sum of
    ``src`` in ``order`` = [(column, descending?), ...], which must be a
    total order (unique keys).  ``df`` should be ``shared`` by the caller
    when it is expensive to recompute.  NULL values are skipped, as by SQL's
    running SUM."""
    n_buckets = n_buckets or range_count(df)
    b = _bucketed(df, order, n_buckets)
    per_bucket = b.groupBy(_BUCKET).agg(*[F.sum(src).alias(f"s_{out}") for out, src in sums.items()])
    # One row per range: a running sum over all of them, empty ones included, gives every
    # range the sums before it.  The rows read them from an array, by their range's number
    # (a scalar subquery: no join).
    ranges = df.sparkSession.range(_most_ranges(n_buckets)).select(F.col("id").cast("int").alias("__range"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums_before = ranges.join(per_bucket, F.col("__range") == F.col(_BUCKET), "left").select(
        "__range", *[F.sum(f"s_{out}").over(before).alias(out) for out in sums])
    prefixes = sums_before.agg(F.sort_array(F.collect_list(F.struct("__range", *sums)))).scalar()
    w = Window.partitionBy(_BUCKET).orderBy(_KEY).rowsBetween(Window.unboundedPreceding, 0)
    out = b
    for name, src in sums.items():
        local = F.sum(src).over(w)
        prev = F.get(prefixes, F.col(_BUCKET))[name]
        out = out.withColumn(name, F.when(prev.isNull(), local).when(local.isNull(), prev)
                             .otherwise(prev + local))
    return out.drop(_BUCKET, _KEY)


def rank_desc(df: DataFrame, value_col: str, tie_cols: list[str], rank_col: str,
              running: dict[str, str] | None = None, n_buckets: int | None = None,
              already_shared: bool = False) -> DataFrame:
    """Add ``rank_col`` = RANK() OVER (ORDER BY value_col DESC) and, for each
    ``out -> src`` in ``running``, the running sum of ``src`` in the order
    (value_col DESC, *tie_cols) with rows-frame semantics.

    ``value_col`` must be numeric; ``tie_cols`` must make the order total
    for running sums to be defined."""
    if not already_shared:
        df = shared(df)
    counts = df.groupBy(value_col).agg(F.count(F.lit(1)).alias("__cnt"))
    ranks = running_sums(counts, [(value_col, True)], {"__cum": "__cnt"}, n_buckets).select(
        value_col, (F.col("__cum") - F.col("__cnt") + 1).cast("int").alias(rank_col))
    ranks = ranks.withColumnRenamed(value_col, "__rank_value")
    out = df.join(ranks, df[value_col].eqNullSafe(ranks["__rank_value"])).drop("__rank_value")
    if running:
        out = running_sums(out, [(value_col, True)] + [(c, False) for c in tie_cols], running, n_buckets)
    return out


def rank_of(df: DataFrame, value_col: str, some: DataFrame, rank_col: str) -> DataFrame:
    """``some`` (a bounded number of rows of ``df``) with RANK() OVER (ORDER BY
    value_col DESC) among all rows of ``df``: every row adds one to the ranks
    of the smaller values among ``some``, in one aggregate over ``df``."""
    values = some.agg(F.collect_set(value_col)).scalar()
    beside = df.select(F.col(value_col), values.alias("__values"))
    larger = beside.select(F.explode(F.filter("__values", lambda v: F.col(value_col) > v)).alias("__v")) \
        .groupBy("__v").agg(F.count(F.lit(1)).alias("__larger"))
    out = some.join(larger, some[value_col].eqNullSafe(larger["__v"]), "left")
    n_values = df.agg(F.count(value_col)).scalar()
    larger_than = F.when(F.col(value_col).isNull(), n_values).otherwise(F.coalesce("__larger", F.lit(0)))
    return out.withColumn(rank_col, (larger_than + 1).cast("int")).drop("__v", "__larger")


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """First ``k`` rows in ``order`` (planned as TakeOrderedAndProject: each
    partition keeps its own top k, only k rows per partition move)."""
    return df.orderBy(*order).limit(k)
