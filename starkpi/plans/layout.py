"""Physical layout of the fact table (L1-L3), the Spark form of the
reference's indexes.

``by_month``: partitioned by ``order_month`` (first day of the month), rows
sorted by (order_date, product_id) inside files, so
  - a date predicate plus the derived month predicate prunes directories,
  - Parquet row-group min/max statistics skip by date and product inside,
  - the shuffle before the write is a REBALANCE on the month: AQE splits a
    hot month into several tasks (and merges small ones) from the actual
    shuffle sizes, so no task writes a third of the table alone, and no
    sampling pass re-runs the upstream plan (as range partitioning would).
Point lookups by order, customer or product (the reference's other indexes):
every id column gets a Parquet Bloom filter in each row group whose dictionary
does not hold the column's values anyway, so that an equality on an id skips
the row groups that lack it (``explorer.order_lines``, ``customer_lines``).

``clustered``: one dataset along a space-filling curve over date, product and
customer, so that a filter on any one of them skips row groups by their
minima and maxima (``by_month`` helps dates only).  Costs one more pass over
the facts, for the bounds of the columns' quantiles.

``plain``: one unpartitioned Parquet dataset (the "no index" baseline).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

from starkpi.schema import FACT_SALES

LAYOUTS = ("plain", "by_month", "clustered")
CLUSTER_COLUMNS = ("order_date", "product_id", "customer_id")
ID_COLUMNS = ("order_id", "customer_id", "product_id")


def with_order_month(df: DataFrame) -> DataFrame:
    return df.withColumn("order_month", F.trunc("order_date", "month"))


def fact_writer(df: DataFrame, layout: str = "by_month", max_records_per_file: int = 5_000_000,
                observation: Observation | None = None, files: int | None = None) -> DataFrameWriter:
    """L1-L3: the one writer of facts, in the requested layout and the fact table's
    types (overwrite); ``observation`` counts the rows written as ``rows``; ``files`` sets
    the parts of the ``clustered`` layout, else Spark sizes them."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    types = {f.name: f.dataType for f in FACT_SALES.fields}
    out = df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
    if layout == "by_month":
        out = month_sorted(out)
    if layout == "clustered":
        out = clustered(out, files=files)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode("overwrite").option("maxRecordsPerFile", str(max_records_per_file))
    if layout == "plain":
        return writer
    for c in ID_COLUMNS:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    # filters sized by the values that a row group turns out to have
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    return writer.partitionBy("order_month") if layout == "by_month" else writer


def write_fact(df: DataFrame, path: str, layout: str = "by_month", **options) -> None:
    """L1-L3: write the fact below ``path``."""
    fact_writer(df, layout, **options).parquet(path)


def month_sorted(df: DataFrame) -> DataFrame:
    """Fact rows with ``order_month``, rebalanced on it and sorted inside
    each task by (order_month, order_date, product_id)."""
    return (with_order_month(df).hint("rebalance", "order_month")
            .sortWithinPartitions("order_month", "order_date", "product_id"))


def _rank(column: str, bounds: list) -> Column:
    """How many of the sorted ``bounds`` the column reaches; none for NULL."""
    reached = F.lit(0)
    for b in bounds:
        reached = reached + F.when(F.col(column) >= F.lit(b), 1).otherwise(0)
    return reached


def curve_key(df: DataFrame, columns: tuple[str, ...] = CLUSTER_COLUMNS, bits: int = 5) -> Column:
    """A row's place on the Z-curve: the interleaved bits of its columns' ranks among the
    2 ** ``bits`` quantiles of each column.  Runs one aggregate over ``df``, of which the
    driver gets 2 ** ``bits`` bounds a column; quantiles that are equal (a hot value) count once."""
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    found = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in columns]).first()
    key = F.lit(0).cast("long")
    for at, c in enumerate(columns):
        rank = _rank(c, sorted(set(found[c] or [])))
        for bit in range(bits):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + at))
    return key


def clustered(df: DataFrame, columns: tuple[str, ...] = CLUSTER_COLUMNS, files: int | None = None) -> DataFrame:
    """Fact rows in ranges of the Z-curve.  Rows of one cell are told apart by the columns
    themselves and the order id, so that a crowded cell spreads over several tasks."""
    order = [curve_key(df, columns).alias("__z"), *columns, "order_id"]
    placed = df.select("*", order[0])
    parts = [files] if files else []
    return placed.repartitionByRange(*parts, "__z", *order[1:]).sortWithinPartitions("__z", *order[1:]).drop("__z")


def read_fact(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
