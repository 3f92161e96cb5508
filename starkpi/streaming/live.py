"""Live KPIs as a stateful stream.

The lines that ingest appends are a stream of their own: every file of the target is read
once, when it is new.  A line counts towards three groups: its day, its product's category
and the total.  Structured Streaming's state store keeps, per group, the sums so far, and the
order ids that have been counted in it; an order counts for a group when its id is first
seen there, so that distinct order counts are exact and never summed over groups.  Each
micro-batch emits the groups it has changed (update mode), whatever the target holds.

State: a row per (group, order) and a row per group, dealt by their hash: no group's orders
lie in one value or one task, and the RocksDB store keeps them on disk.  A restart goes on
from the checkpoint.

The result is a log of the changed groups, a folder a micro-batch, rewritten whole if a batch
is run again.  Every ``compact_every``-th batch writes all groups; readers start there.
Lines whose product is unknown count for no category, lines without a date for no day, as in
the joins of the views; lines with a NULL order id count for the sums, not as an order."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starkpi.functions.numeric import MONEY, money_out, pct, ratio
from starkpi.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def appended_lines(spark: SparkSession, target: str, schema: StructType | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """The lines of a fact table, file by file as they are appended; without ``schema`` some
    must be there already."""
    reader = spark.readStream.schema(schema or spark.read.parquet(target).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(target)


def grouped(lines: DataFrame, product: DataFrame) -> DataFrame:
    """(grain, member, order_id, sales_amount, profit): each line once for each of its groups."""
    joined = lines.join(product.select("product_id", "category"), "product_id", "left")
    groups = F.array(*[F.struct(F.lit(grain).alias("grain"), member.cast("string").alias("member")) for grain, member in (
        ("day", F.col("order_date")), ("category", F.col("category")), ("total", F.lit("")))])
    return joined.select(F.explode(groups).alias("g"), "order_id", "sales_amount", "profit").where("g.member IS NOT NULL").select(
        "g.grain", "g.member", "order_id", "sales_amount", "profit")


def running_kpis(lines: DataFrame, product: DataFrame) -> DataFrame:
    """(grain, member, revenue, profit, lines, orders) of all lines so far; over a stream, of
    the groups that a micro-batch changes (update mode)."""
    rows = grouped(lines, product)
    zero = F.lit(0).cast(MONEY)
    sums = rows.select("grain", "member", "sales_amount", "profit", F.lit(1).alias("line"), F.lit(0).alias("order"))
    orders = rows.where("order_id IS NOT NULL").select("grain", "member", "order_id").dropDuplicates().select(
        "grain", "member", zero.alias("sales_amount"), zero.alias("profit"), F.lit(0).alias("line"), F.lit(1).alias("order"))
    return sums.unionByName(orders).groupBy("grain", "member").agg(
        F.sum("sales_amount").alias("revenue"), F.sum("profit").alias("profit"),
        F.sum("line").alias("lines"), F.sum("order").alias("orders"))


def start(spark: SparkSession, lines: DataFrame, product: DataFrame, path: str, checkpoint: str | None = None,
          available_now: bool = True, compact_every: int = 20):
    """Start the stream over ``lines`` into the log at ``path``; returns the StreamingQuery."""
    def log(changed: DataFrame, batch_id: int) -> None:
        held = _log(changed.sparkSession, path, before=batch_id) if batch_id % compact_every == 0 else None
        if held is not None:
            kept = held.join(changed.select("grain", "member"), ["grain", "member"], "left_anti")
            changed = changed.unionByName(kept)
        # whole: the batch has every group, older ones need not be read
        changed.withColumn("whole", F.lit(held is not None)).write.mode("overwrite").parquet(os.path.join(path, f"batch={batch_id}"))

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ckpt = checkpoint or scratch_path(spark, os.path.join("live", os.path.basename(path.rstrip("/"))))
    w = running_kpis(lines, product).writeStream.outputMode("update").foreachBatch(log).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def run_available(spark: SparkSession, *args, **kwargs) -> None:
    """Count every file not yet seen, then return (a scheduled run)."""
    start(spark, *args, available_now=True, **kwargs).awaitTermination()


def _log(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest row of each group among the batches (those ``before`` one)."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    first = rows.where("whole").agg(F.max("batch")).first()[0] or 0
    newest = Window.partitionBy("grain", "member").orderBy(F.col("batch").desc())
    return rows.where(F.col("batch") >= first).withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n", "batch", "whole")


def kpis(spark: SparkSession, path: str, grain: str) -> DataFrame:
    """The present KPIs of a grain: ``day``, ``category`` or ``total``."""
    rows = _log(spark, path)
    if rows is None:
        raise ValueError(f"no batch was counted yet: {path}")
    return rows.where(F.col("grain") == grain).drop("grain").withColumnRenamed("member", grain)


def summary(spark: SparkSession, path: str) -> DataFrame:
    """The KPI row (V1) over everything counted so far, without reading a line."""
    return kpis(spark, path, "total").select(
        money_out("revenue").alias("total_revenue"), money_out("profit").alias("total_profit"),
        pct("profit", "revenue").alias("margin_pct"), F.col("orders").alias("total_orders"),
        ratio("revenue", "orders").alias("avg_order_value"))
