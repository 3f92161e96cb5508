"""The star schema as four DataFrames, and its standard joins.

``Star.from_testdata`` derives the star lazily from the TPC-H-like tables:

  fact      lineitem JOIN orders (order date, customer) JOIN part (unit cost)
  product   part                     (name, type -> category, brand -> sub_category)
  customer  customer JOIN nation JOIN region
  date      calendar of the whole years spanned by the order dates

``Star.from_layout`` reads a star that ``plans.etl.build_star`` materialised.
For repeated querying at scale the materialised form is the one to use: the
large lineitem/orders join is then paid once, at load time.

Join policy: no broadcast hints.  Catalyst and AQE broadcast a dimension when
its known or measured size is below ``spark.sql.autoBroadcastJoinThreshold``
(nation, region, a calendar); otherwise the joins stay shuffle joins.  A
calendar generated from the facts' own span is not joined at all, see
``fact_calendar``.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starkpi.functions.calendar import calendar_covering, calendar_fields
from starkpi.functions.numeric import MONEY, RATE, UNIT_COST
from starkpi.functions.pricing import line_profit

FACT_COLUMNS = ["order_id", "line_number", "product_id", "supplier_id", "customer_id",
                "order_date", "ship_date", "quantity", "unit_price", "discount",
                "sales_amount", "profit"]

# Columns that make one fact line unique in the test data, used as the
# deterministic tie-breaker wherever the reference leaves order undefined.
LINE_ORDER = ["order_id", "line_number", "product_id", "supplier_id", "ship_date",
              "quantity", "sales_amount"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("long").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_retailprice").cast(UNIT_COST).alias("unit_cost"))


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    cust = read_table(spark, sf_dir, "customer")
    return cust.join(geo, cust.c_nationkey == geo.n_nationkey).select(
        F.col("c_custkey").cast("long").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"))


# Lines that one task joins to their orders, about, and those up to which Spark deals them.
TASK_LINES, FEW_LINES = 500_000, 4_000_000


def order_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, int]:
    """Lineitem, orders and into how many parts their join is dealt by order: parts of about
    ``TASK_LINES`` lines (by the count in the files' footers), or 0, as Spark sees fit, for few
    lines.  What a task of the join and of aggregates by order behind it holds then stays the
    same however large the tables are."""
    li = read_table(spark, sf_dir, "lineitem")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = li.count()
    return li, od, -(-lines // TASK_LINES) if lines > FEW_LINES else 0


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem joined to its order, mapped to fact columns without pricing
    from the product table (no profit yet)."""
    return lines_of(*order_parts(spark, sf_dir))


def lines_of(li: DataFrame, od: DataFrame, parts: int, *more: str) -> DataFrame:
    """Fact columns of lines joined to their orders in ``parts`` parts, and ``more`` columns of
    the orders."""
    if parts:
        li, od = li.repartition(parts, "l_orderkey"), od.repartition(parts, "o_orderkey")
    discount = F.col("l_discount").cast(RATE)
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("int").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).cast("decimal(20,6)"), 2)
        .cast(MONEY).alias("unit_price"),
        discount.alias("discount"),
        F.round(F.col("l_extendedprice").cast("decimal(12,2)")
                * (F.lit(1).cast("decimal(3,0)") - discount), 2).cast(MONEY).alias("sales_amount"), *more)


@dataclass(frozen=True)
class Star:
    """Fact, product, customer and calendar DataFrames.

    ``calendar_spans_fact`` marks a calendar generated from the fact's own
    date span: every dated fact is inside it, so J1 needs no join (and no
    scan for the bounds) and calendar attributes come from the order date.

    ``lines`` (optional) is the fact *without* profit, whose profit comes
    from the product's unit cost.  When present, product-joined views join
    the product table once and derive profit from that join, and
    product-level sums derive it after aggregation (see ``product_sums``),
    instead of joining the product table a second time for the cost.
    """
    fact: DataFrame
    product: DataFrame
    customer: DataFrame
    date: DataFrame
    lines: DataFrame | None = None
    calendar_spans_fact: bool = False
    # what ``order_parts`` gives, of which the lines are joined
    parts: tuple[DataFrame, DataFrame, int] | None = None
    # into how many parts to deal lines by other keys than their order; 0: as Spark sees fit
    tasks: int = 0
    # columns that identify a fact line; None: line_id, the source's surrogate key
    line_key: tuple[str, ...] | None = None
    # values that could not be read as their column's type (CSV sources)
    cast_failures: DataFrame | None = None

    # ---- constructors ---------------------------------------------------
    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Star":
        product = product_dim(spark, sf_dir)
        parts = order_parts(spark, sf_dir)
        lines = lines_of(*parts)
        cost = product.select(F.col("product_id").alias("cost_pid"), "unit_cost")
        fact = lines.join(cost, lines.product_id == cost.cost_pid).select(
            *[c for c in FACT_COLUMNS if c != "profit"],
            line_profit("sales_amount", "quantity", "unit_cost").alias("profit"))
        orders = read_table(spark, sf_dir, "orders").select("o_orderdate")
        return cls(fact=fact, product=product, customer=customer_dim(spark, sf_dir),
                   date=calendar_covering(orders, "o_orderdate"), lines=lines,
                   calendar_spans_fact=True, parts=parts, tasks=parts[2], line_key=tuple(LINE_ORDER))

    @classmethod
    def from_csv(cls, spark: SparkSession, paths: dict[str, str]) -> "Star":
        """The star from its four CSV files (keys ``dim_product``,
        ``dim_customer``, ``dim_date``, ``fact_sales``), columns matched by
        header name, unparsable values NULL and listed in ``cast_failures``.  Not
        cleaned: see ``plans.etl``."""
        from starkpi.sources.io import read_star_csv, star_cast_failures
        t = read_star_csv(spark, paths)
        return cls(fact=t["fact_sales"], product=t["dim_product"], customer=t["dim_customer"],
                   date=t["dim_date"], cast_failures=star_cast_failures(spark, paths))

    @classmethod
    def from_layout(cls, spark: SparkSession, root: str) -> "Star":
        """Read a star written by ``plans.etl.run_pipeline``: the version published
        last, or tables that lie under ``root`` itself.  A month-partitioned
        fact keeps its ``order_month`` column: date filters add the matching
        month predicate, which prunes partition directories."""
        from starkpi.sources.snapshots import resolve
        folder = resolve(spark, root)

        def rd(name):
            return spark.read.parquet(os.path.join(folder, name))
        return cls(fact=rd("fact_sales"), product=rd("dim_product"), customer=rd("dim_customer"),
                   date=rd("dim_date"))

    @classmethod
    def from_catalog(cls, spark: SparkSession, prefix: str = "") -> "Star":
        """Read a star saved as catalog tables (``plans.etl.load_star_tables``)."""
        return cls(fact=spark.table(prefix + "fact_sales"), product=spark.table(prefix + "dim_product"),
                   customer=spark.table(prefix + "dim_customer"), date=spark.table(prefix + "dim_date"))

    def date_predicate(self, flt, categories: bool = True, countries: bool = True):
        """The filter's predicate, plus the derived ``order_month`` range when
        the fact is month-partitioned (partition pruning)."""
        p = flt.predicate(categories=categories, countries=countries)
        mp = flt.month_predicate() if "order_month" in self.fact.columns else None
        return p & mp if mp is not None else p

    def persist(self, level=None) -> "Star":
        """Keep the four tables (and profit-less lines) cached for a session
        that runs many queries (a dashboard).  MEMORY_AND_DISK by default: a
        lost block is recomputed from the sources, so executor loss is safe."""
        from pyspark import StorageLevel
        lvl = level or StorageLevel.MEMORY_AND_DISK
        return replace(self, fact=self.fact.persist(lvl), product=self.product.persist(lvl),
                       customer=self.customer.persist(lvl), date=self.date.persist(lvl),
                       lines=self.lines.persist(lvl) if self.lines is not None else None, parts=None)

    def unpersist(self) -> None:
        for df in (self.fact, self.product, self.customer, self.date, self.lines):
            if df is not None:
                df.unpersist()

    def with_fact(self, fact: DataFrame) -> "Star":
        return replace(self, fact=fact, lines=None, parts=None, calendar_spans_fact=False)

    # ---- standard joins -------------------------------------------------
    def fact_calendar(self, where: Column | None = None) -> DataFrame:
        """Facts inner-joined to the calendar (facts outside it drop), on the days
        that ``where`` selects by the calendar's attributes.  With a calendar spanning the
        facts the join reduces to deriving the attributes from the order date (NULL dates
        still drop).  On a month-partitioned fact the selected days' months join the
        partition column as well, so that Spark prunes directories while it runs."""
        if self.calendar_spans_fact:
            dated = self.fact.filter(F.col("order_date").isNotNull()).select("*", *calendar_fields("order_date"))
            return dated if where is None else dated.filter(where)
        if where is None:
            return self.fact.join(self.date, F.col("order_date") == F.col("date_id"))
        days, on = self.date.filter(where), F.col("order_date") == F.col("date_id")
        if "order_month" not in self.fact.columns:
            return self.fact.join(days, on)
        days = days.withColumn("_month", F.trunc("date_id", "month"))
        return self.fact.join(days, on & (F.col("order_month") == F.col("_month"))).drop("_month")

    def fact_products(self, fact: DataFrame | None = None) -> DataFrame:
        """Facts inner-joined to products (one product join; profit from
        its unit cost when the star holds profit-less lines)."""
        if fact is None and self.lines is not None:
            return self.lines.join(self.product, "product_id").withColumn(
                "profit", line_profit("sales_amount", "quantity", "unit_cost"))
        return (fact if fact is not None else self.fact).join(self.product, "product_id")

    def fact_customers(self, fact: DataFrame | None = None) -> DataFrame:
        """Facts inner-joined to customers."""
        return (fact if fact is not None else self.fact).join(self.customer, "customer_id")

    def sales(self) -> DataFrame:
        """The three-way star join (fact, product, customer).  Where the lines are still to
        be joined to their orders, the orders take their customers along: customers then meet
        a row per order, and no shuffle by customer moves every line with all its names."""
        if self.parts is None:
            return self.fact_products().join(self.customer, "customer_id")
        li, od, parts = self.parts
        buyers = od.join(self.customer, od.o_custkey == self.customer.customer_id).drop("customer_id")
        named = [c for c in self.customer.columns if c != "customer_id"]
        product = [c for c in self.product.columns if c != "product_id"]
        j = lines_of(li, buyers, parts, *named).join(self.product, "product_id").withColumn(
            "profit", line_profit("sales_amount", "quantity", "unit_cost"))
        rest = [c for c in self.lines.columns if c not in ("customer_id", "product_id")]
        return j.select("customer_id", "product_id", *rest, *product, "profit", *named)

    def product_sums(self, how: str = "inner", product: DataFrame | None = None) -> DataFrame:
        """Per product (all product columns): revenue ``_rev``, profit ``_pro``,
        quantity ``_qty`` and line count ``_lines``, summed over the facts by
        product_id *before* the product join (one row per product reaches
        the join).  ``how='left'`` keeps products without sales (NULL sums).

        With profit-less lines, profit is derived after the join:
        sum(sales - quantity * cost) = sum(sales) - cost * sum(quantity),
        exact in decimals since each line's profit is a whole-cent value."""
        prod = product if product is not None else self.product

        def wanted(lines):
            # a restricted product list: lines of other products are not summed
            return lines if product is None else lines.join(product.select("product_id"), "product_id", "left_semi")

        if self.lines is not None:
            per = wanted(self.lines).groupBy("product_id").agg(
                F.sum("sales_amount").alias("_rev"), F.sum("quantity").alias("_qty"),
                F.count(F.lit(1)).alias("_lines"))
            j = prod.join(per, "product_id", how)
            return j.withColumn("_pro", F.col("_rev") - F.col("unit_cost") * F.col("_qty"))
        per = wanted(self.fact).groupBy("product_id").agg(
            F.sum("sales_amount").alias("_rev"), F.sum("profit").alias("_pro"),
            F.sum("quantity").alias("_qty"), F.count(F.lit(1)).alias("_lines"))
        return prod.join(per, "product_id", how)
