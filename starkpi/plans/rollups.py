"""The six KPI views kept up to date month by month.

A rollup is one table of rows of several kinds, each belonging to one month of the fact:

  day       revenue and profit per order date
  product   revenue, profit, quantity and lines per product id
  customer  revenue and last order date per customer id
  visit     the different (order date, customer, category, order) of the month
  order     bitmaps of the month's order numbers; ``dated`` those of days in the calendar,
            ``category`` and ``country`` those of each category and country

Sums of months add up, and so do bitmaps (``operators.bitmaps``), so that every view comes
from these rows without reading a line, distinct orders included: an order whose lines lie in
two months counts once.  ``refresh`` makes the rows of those months anew whose files are not
the ones that their rows were made from; the rows of all other months stay where they are.
Making a month anew does not depend on what was there: a refresh that dies is run again.
A changed product, customer or calendar table makes all months anew, since bitmaps carry their
attributes (categories and countries are NOT NULL columns of the star).

One refresh writes one folder and publishes it in one commit (``sources.snapshots``) together
with the list of which folder holds which month, so that readers see all of it or nothing.
Of two refreshes at once one is read; months that only the other made are found changed, and
made anew, by the next one.  The driver holds the fact's file names (as Spark's own file index
does) and a row per month."""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, DateType, DecimalType, IntegerType, LongType,
                               StringType, StructField, StructType)

from starkpi.functions.numeric import money_out, pct, ratio
from starkpi.operators import bitmaps
from starkpi.plans import kpis
from starkpi.plans.layout import with_order_month
from starkpi.sources import snapshots
from starkpi.sources.star import Star

_SUM = DecimalType(28, 2)
ROWS = StructType([StructField(name, kind) for name, kind in (
    ("day", DateType()), ("key", LongType()), ("category", StringType()), ("region", StringType()), ("country", StringType()),
    ("year", IntegerType()), ("month", IntegerType()), ("month_name", StringType()), ("revenue", _SUM), ("profit", _SUM),
    ("quantity", LongType()), ("lines", LongType()), ("number", LongType()), ("__chunk", LongType()), ("__bits", BinaryType()))])
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # Spark's name for the folder of NULL


def _rows(df: DataFrame, kind: str, **columns: str | Column) -> DataFrame:
    """``df`` as rows of the rollup; a column not given is taken by its name, or NULL."""
    def value(field):
        c = columns.get(field.name, field.name if field.name in df.columns else F.lit(None))
        return (F.col(c) if isinstance(c, str) else c).cast(field.dataType).alias(field.name)
    slot = F.coalesce(F.col("order_month").cast("string"), F.lit(_NO_MONTH)).alias("slot")
    return df.select(slot, F.lit(kind).alias("kind"), *map(value, ROWS.fields))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sum_rows(lines: DataFrame, tasks: int = 0) -> DataFrame:
    """The kinds ``day``, ``product`` and ``customer`` of fact lines with ``order_month``.  Few
    lines share a month and a product or customer: the tables of those sums grow with the
    lines, which ``tasks`` (not 0) tasks then share."""
    def by(key):
        return (lines.repartition(tasks, "order_month", key) if tasks else lines).groupBy("order_month", key)
    money = [F.sum("sales_amount").alias("revenue"), F.sum("profit").alias("profit")]
    day = lines.groupBy("order_month", "order_date").agg(*money)
    product = by("product_id").agg(*money, F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("lines"))
    customer = by("customer_id").agg(money[0], F.max("order_date").alias("day"))
    return _union([_rows(day, "day", day="order_date"), _rows(product, "product", key="product_id"),
                   _rows(customer, "customer", key="customer_id")])


def line_visits(lines: DataFrame, product: DataFrame) -> DataFrame:
    """The visit that each line with an order id is part of, as often as it has lines."""
    named = lines.where("order_id IS NOT NULL").join(product.select("product_id", "category"), "product_id", "left")
    return named.select("order_month", F.col("order_date").alias("day"), F.col("customer_id").alias("key"), "category", "order_id")


def visit_rows(lines: DataFrame, product: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """The kind ``visit``.  ``numbers`` (order_id, number) numbers the orders; without it their
    ids are integers.  Lines without an order id visit nothing."""
    visits = line_visits(lines, product).distinct()
    visits = visits.withColumnRenamed("order_id", "number") if numbers is None else visits.join(numbers, "order_id")
    return _rows(visits, "visit")


def bitmap_rows(visits: DataFrame, star: Star) -> DataFrame:
    """The kinds ``order``, ``dated``, ``category`` and ``country``, from visits (some of which
    may come more often than once: a bit is set or not)."""
    v = visits.select(F.when(F.col("slot") != _NO_MONTH, F.col("slot")).alias("order_month"), "day", "key", "category", "number")
    days = star.date.select(F.col("date_id").alias("day"), "year", "month", "month_name")
    places = star.customer.select(F.col("customer_id").alias("key"), "region", "country")
    return _union([_rows(bitmaps.id_bitmaps(rows, "number", ["order_month", *by]), kind) for kind, rows, by in (
        ("order", v, []),
        ("dated", v.join(days, "day"), ["year", "month", "month_name"]),
        ("category", v.where("category IS NOT NULL"), ["category"]),
        ("country", v.join(places, "key"), ["region", "country"]))])


def rollup_rows(star: Star) -> DataFrame:
    """The whole rollup of a star as one lazy plan (order ids must be integers)."""
    lines = star.fact if "order_month" in star.fact.columns else with_order_month(star.fact)
    # bitmaps need no different visits: those of lines spare a task the tables of them
    repeated = _rows(line_visits(lines, star.product), "visit", number="order_id")
    return _union([sum_rows(lines, star.tasks), visit_rows(lines, star.product), bitmap_rows(repeated, star)])


# ---- the maintained table -------------------------------------------------

def _signatures(files: list[str], column: str) -> dict[str, str]:
    """What identifies the files below each folder of the partition ``column``."""
    held: dict[str, list[str]] = {}
    for f in files:
        found = re.search(rf"/{column}=([^/]+)/", f)
        if found is None:
            raise ValueError(f"not partitioned by {column}: {f}")
        held.setdefault(found.group(1), []).append(f)
    return {slot: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest() for slot, names in held.items()}


def _state(spark: SparkSession, root: str) -> dict:
    now = snapshots.current(spark, root)
    return json.loads(now.state) if now else {"dims": "", "months": {}, "numbers": []}


def _numbers(spark: SparkSession, root: str, folders: list[str]) -> DataFrame | None:
    paths = [os.path.join(root, "numbers", f) for f in folders]
    return spark.read.schema("order_id string, number long").parquet(*paths) if paths else None


def refresh(spark: SparkSession, star: Star, root: str) -> dict:
    """Bring the rollup below ``root`` up to a month-partitioned ``star`` (``Star.from_layout``,
    read after the append).  Returns the months made anew (``months``), those that are gone
    (``dropped``) and the fact lines read for their sums (``lines``)."""
    files = _signatures(star.fact.inputFiles(), "order_month")
    dims = hashlib.sha256("\n".join(sorted(
        f for t in (star.product, star.customer, star.date) for f in t.inputFiles())).encode()).hexdigest()
    state = _state(spark, root)
    held = state["months"] if state["dims"] == dims else {}
    touched = sorted(s for s, signature in files.items() if held.get(s, {}).get("files") != signature)
    gone = sorted(set(state["months"]) - set(files))
    if not touched and not gone and state["dims"] == dims:
        return {"months": [], "dropped": [], "lines": 0}
    version, folder = snapshots.new_folder(spark, root)
    made, read = {}, 0
    if touched:
        dated = [s for s in touched if s != _NO_MONTH]
        wanted = F.col("order_month").isin([F.lit(s).cast("date") for s in dated]) if dated else F.lit(False)
        if _NO_MONTH in touched:
            wanted = wanted | F.col("order_month").isNull()
        lines = star.fact.where(wanted)
        known = _numbers(spark, root, state["numbers"])
        bitmaps.number_ids(lines.select(F.col("order_id").cast("string")), "order_id", known, version).write.parquet(
            os.path.join(root, "numbers", folder))
        state["numbers"].append(folder)
        path, seen = os.path.join(root, "rows", f"made={folder}"), Observation()
        counted = lines.observe(seen, F.count(F.lit(1)).alias("lines"))
        _write(sum_rows(lines), path)
        _write(visit_rows(counted, star.product, _numbers(spark, root, state["numbers"])), path)
        _write(bitmap_rows(_read(spark, root, [path]).where("kind = 'visit'"), star), path)
        read = seen.get["lines"]
        present = _signatures(_read(spark, root, [path]).inputFiles(), "slot")
        made = {s: {"folder": folder, "files": files[s]} for s in touched if s in present}
    months = {s: m for s, m in held.items() if s in files and s not in touched} | made
    snapshots.publish(spark, root, version, folder, json.dumps({"dims": dims, "months": months, "numbers": state["numbers"]}))
    return {"months": touched, "dropped": gone, "lines": read}


def _write(rows: DataFrame, path: str) -> None:
    rows.hint("rebalance", "slot", "kind").write.mode("append").partitionBy("slot", "kind").parquet(path)


def _read(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    schema = StructType([*ROWS.fields, *(StructField(c, StringType()) for c in ("made", "slot", "kind"))])
    return spark.read.option("basePath", os.path.join(root, "rows")).schema(schema).parquet(*paths)


def read_rollup(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all months as the last refresh left them; none before the first."""
    months = sorted(_state(spark, root)["months"].items())
    paths = [os.path.join(root, "rows", f"made={m['folder']}", f"slot={s}") for s, m in months]
    if not paths:
        return spark.createDataFrame([], StructType([*ROWS.fields, StructField("kind", StringType())]))
    return _read(spark, root, paths).drop("made", "slot")


# ---- the views --------------------------------------------------------------

@dataclass(frozen=True)
class RolledStar(Star):
    """A star whose per-product sums come from a rollup, for the plans that only need those
    (product performance, its list and its shares)."""
    rollup: DataFrame | None = None

    @classmethod
    def over(cls, star: Star, rollup: DataFrame) -> RolledStar:
        return cls(**{**star.__dict__, "rollup": rollup})

    def kind(self, name: str) -> DataFrame:
        return self.rollup.where(F.col("kind") == name)

    def product_sums(self, how: str = "inner", product: DataFrame | None = None) -> DataFrame:
        per = self.kind("product").groupBy(F.col("key").alias("product_id")).agg(
            F.sum("revenue").alias("_rev"), F.sum("profit").alias("_pro"),
            F.sum("quantity").alias("_qty"), F.sum("lines").alias("_lines"))
        return (self.product if product is None else product).join(per, "product_id", how)


def _orders(star: RolledStar, kind: str, groups: list[str]) -> DataFrame:
    return bitmaps.distinct_counts(star.kind(kind), groups, "_orders")


def _with_orders(sums: DataFrame, orders: DataFrame, groups: list[str]) -> DataFrame:
    """``sums`` (_rev, _pro) and order counts per group, none of either being lost; a group
    has both or only sums (its lines then have no order ids)."""
    return sums.unionByName(orders, allowMissingColumns=True).groupBy(*groups).agg(
        F.sum("_rev").alias("_rev"), F.sum("_pro").alias("_pro"),
        F.coalesce(F.sum("_orders"), F.lit(0)).cast("long").alias("_orders"))


def rolled(star: Star) -> RolledStar:
    """A star over its own rollup, nothing written: for checks of the views (integer ids)."""
    return RolledStar.over(star, rollup_rows(star))


def kpi_summary(star: RolledStar) -> DataFrame:
    """V1 from the rollup."""
    sums = star.kind("day").select(F.col("revenue").alias("_rev"), F.col("profit").alias("_pro"))
    return _with_orders(sums, _orders(star, "order", []), []).select(
        money_out("_rev").alias("total_revenue"), money_out("_pro").alias("total_profit"),
        pct("_pro", "_rev").alias("margin_pct"), F.col("_orders").alias("total_orders"),
        ratio("_rev", "_orders").alias("avg_order_value"))


def monthly_revenue(star: RolledStar) -> DataFrame:
    """V2 from the rollup."""
    by = ["year", "month", "month_name"]
    days = star.date.select(F.col("date_id").alias("day"), *by)
    sums = star.kind("day").select("day", F.col("revenue").alias("_rev"), F.col("profit").alias("_pro")).join(days, "day").drop("day")
    return _with_orders(sums, _orders(star, "dated", by), by).select(
        *by, money_out("_rev").alias("total_revenue"), money_out("_pro").alias("total_profit"),
        F.col("_orders").alias("order_count")).orderBy("year", "month")


def product_performance(star: RolledStar) -> DataFrame:
    """V3 from the rollup."""
    return kpis.product_performance(star)


def category_performance(star: RolledStar) -> DataFrame:
    """V4 from the rollup."""
    sums = star.product_sums().select("category", "_rev", "_pro")
    return _with_orders(sums, _orders(star, "category", ["category"]), ["category"]).select(
        "category", money_out("_rev").alias("total_revenue"), money_out("_pro").alias("total_profit"),
        pct("_pro", "_rev").alias("margin_pct"), F.col("_orders").alias("order_count")).orderBy(
        F.col("total_revenue").desc(), "category")


def regional_performance(star: RolledStar) -> DataFrame:
    """V5 from the rollup."""
    by = ["region", "country"]
    per = star.kind("customer").groupBy(F.col("key").alias("customer_id")).agg(F.sum("revenue").alias("_rev"))
    sums = per.join(star.customer, "customer_id").select(*by, "_rev", F.lit(None).cast(_SUM).alias("_pro"))
    return _with_orders(sums, _orders(star, "country", by), by).select(
        *by, money_out("_rev").alias("total_revenue"), F.col("_orders").alias("order_count"),
        ratio("_rev", "_orders").alias("avg_order_value")).orderBy(F.col("total_revenue").desc(), *by)


def customer_rfm(star: RolledStar) -> DataFrame:
    """V6 from the rollup: orders are counted over visits, since a bitmap per customer would
    hold a few bits each."""
    # lines that lie in parts by order meet all of an order's in one task: it becomes one row there
    orders = star.kind("visit").select("key", "number").distinct()
    rows = star.kind("customer").select("key", "day", "revenue").unionByName(orders, allowMissingColumns=True)
    if star.tasks:
        rows = rows.repartition(star.tasks, "key")
    per = rows.groupBy(F.col("key").alias("customer_id")).agg(
        F.max("day").alias("last_order_date"), F.count("number").alias("frequency"), F.sum("revenue").alias("_rev"))
    return per.join(star.customer, "customer_id").select(
        "customer_id", "customer_name", "segment", "last_order_date", "frequency",
        money_out("_rev").alias("monetary_value")).orderBy(F.col("monetary_value").desc(), "customer_id")


VIEWS = {"kpi_summary": kpi_summary, "monthly_revenue": monthly_revenue, "product_performance": product_performance,
         "category_performance": category_performance, "regional_performance": regional_performance, "customer_rfm": customer_rfm}


def register_views(spark: SparkSession, star: Star, root: str) -> list[str]:
    """The six views, under the names that ``io.register_views`` gives them, over the
    rollup below ``root``; after a refresh they are to be registered anew."""
    rolled = RolledStar.over(star, read_rollup(spark, root))
    for name, view in VIEWS.items():
        view(rolled).createOrReplaceTempView(f"vw_{name}")
    return [f"vw_{name}" for name in VIEWS]
