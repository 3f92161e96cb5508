"""Data-explorer queries (D7-D10), pick lists and lookups (P7-P10), and the
selective benchmark query (D11).

D9 and D10 keep dimension rows without sales (the source system's LEFT JOIN
from the dimension).  In both, facts are pre-aggregated by key first, so one
row per key (or per customer and order) meets the dimension instead of one
per line.  D10 then left-joins the per-product sums (one row per product, no
skew possible); D9 uses an inner join plus NULL-measure rows for every
customer (see ``explore_customers``), because a customer with a large share
of all orders would otherwise sit on the unsplittable side of a left join.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkpi.functions.numeric import money_out, ratio
from starkpi.operators.filters import SalesFilter
from starkpi.operators.ordered import top_k
from starkpi.plans.dashboard import filtered_sales
from starkpi.sources.star import LINE_ORDER, Star

# type of a sum of money values (decimal(18,2) summed)
MONEY_SUM = "decimal(28,2)"


def explore_sales(star: Star, flt: SalesFilter, n: int = 100) -> DataFrame:
    """The latest ``n`` filtered lines with names and per-line margin
    (0 when the line's sales amount is 0), rounded to one decimal."""
    s = filtered_sales(star, flt)
    margin = F.when(F.col("sales_amount") == 0, F.lit(0.0)).otherwise(
        ratio("profit", "sales_amount", scale=1, mult=100.0))
    order = [F.col("order_date").desc()] + [F.col(c) for c in LINE_ORDER]
    latest = top_k(s, n, order)
    return latest.select("order_date", "product_name", "customer_name", "quantity",
                         money_out("sales_amount").alias("sales_amount"),
                         money_out("profit").alias("profit"), margin.alias("margin_pct"))


def explore_sales_totals(star: Star, flt: SalesFilter, n: int = 100) -> DataFrame:
    """Record count and sums over the ``n`` rows shown, not the filter."""
    shown = explore_sales(star, flt, n)
    return shown.agg(F.count(F.lit(1)).alias("records"),
                     F.sum(F.col("sales_amount").cast("decimal(18,2)")).alias("_rev"),
                     F.sum(F.col("profit").cast("decimal(18,2)")).alias("_pro")).select(
        "records", money_out("_rev").alias("total_revenue"), money_out("_pro").alias("total_profit"))


def explore_customers(star: Star, flt: SalesFilter, n: int = 100) -> DataFrame:
    """Customers with or without sales by (name, segment, country),
    country filter only: distinct orders (0 without sales), total spent (NULL
    without sales), average line value, last purchase; top ``n`` by spend.

    Same result as customer LEFT JOIN fact, planned for skew and one fact
    pass: facts are first summed per (customer, order); those rows meet the
    customers in an *inner* join, whose streamed side AQE can split when one
    customer holds a large share of all orders (the non-preserved side of a
    left join cannot be split).  Every selected customer is then added as
    one row of NULL measures: COUNT(DISTINCT), SUM and MAX ignore them where
    a group has sales, and they make a group without sales appear with 0
    orders and NULL amounts, exactly as the left join does."""
    fact, cust = star.fact, star.customer
    cp = flt.country_predicate()
    if cp is not None:  # facts of other customers need not be summed
        cust = cust.filter(cp)
        fact = fact.join(cust.select("customer_id"), "customer_id", "left_semi")
    per_order = fact.groupBy("customer_id", "order_id").agg(
        F.sum("sales_amount").alias("_rev"), F.count("sales_amount").alias("_n"),
        F.max("order_date").alias("_last"))
    keys = ["customer_name", "segment", "country"]
    sold = per_order.join(cust, "customer_id").select(*keys, "order_id", "_rev", "_n", "_last")
    everyone = cust.select(
        *keys, F.lit(None).cast(star.fact.schema["order_id"].dataType).alias("order_id"), F.lit(None).cast(MONEY_SUM).alias("_rev"),
        F.lit(None).cast("long").alias("_n"), F.lit(None).cast(star.fact.schema["order_date"].dataType).alias("_last"))
    g = sold.unionByName(everyone).groupBy(*keys).agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("_rev").alias("_rev"), F.sum("_n").alias("_n"), F.max("_last").alias("last_purchase"))
    out = g.select(*keys, "total_orders", money_out("_rev").alias("total_spent"),
                   ratio("_rev", "_n").alias("avg_order"), "last_purchase")
    return top_k(out, n, [F.col("total_spent").desc_nulls_last(), F.col("customer_name"),
                          F.col("segment"), F.col("country")])


def explore_products(star: Star, flt: SalesFilter) -> DataFrame:
    """Products with or without sales by (name, category, unit cost),
    category filter only.  times_sold is COUNT(*) of the outer join, so an
    unsold product counts 1; avg_margin falls back to 0."""
    prod = star.product
    cp = flt.category_predicate()
    if cp is not None:
        prod = prod.filter(cp)
    j = star.product_sums(how="left", product=prod)
    g = j.groupBy("product_name", "category", "unit_cost").agg(
        F.sum(F.coalesce(F.col("_lines"), F.lit(1))).cast("long").alias("times_sold"),
        F.sum("_qty").cast("long").alias("units_sold"),
        F.sum("_rev").alias("_rev"), F.sum("_pro").alias("_pro"))
    return g.select(
        "product_name", "category", F.col("unit_cost").cast("double").alias("unit_price"),
        "times_sold", "units_sold", money_out("_rev").alias("total_revenue"),
        F.coalesce(ratio("_pro", "_rev", scale=1, mult=100.0), F.lit(0.0)).alias("avg_margin")
    ).orderBy(F.col("total_revenue").desc_nulls_last(), "product_name", "category", "unit_price")


def bench_month_product(star: Star, start: _dt.date | str, end: _dt.date | str) -> DataFrame:
    """Revenue, profit and line count per (product name, category) over
    an inclusive date range (one month in the benchmark), descending."""
    flt = SalesFilter(start, end)
    return (star.fact_products().filter(star.date_predicate(flt))
            .groupBy("product_name", "category")
            .agg(money_out(F.sum("sales_amount")).alias("revenue"),
                 money_out(F.sum("profit")).alias("profit"),
                 F.count(F.lit(1)).alias("line_items"))
            .orderBy(F.col("revenue").desc(), "product_name", "category"))


# ---- pick lists and lookups ---------------------------------------------

def product_lookup(star: Star, product_id: int) -> DataFrame:
    """Unit cost and category of one product (point lookup)."""
    return star.product.filter(F.col("product_id") == F.lit(product_id)).select(
        F.col("unit_cost").cast("double").alias("unit_cost"), "category")


def _lines_by_id(star: Star, column: str, value) -> DataFrame:
    """The fact's lines with one value of an id column, as given in the column's type, so
    that the equality reaches the scan and its Bloom filters."""
    key = F.lit(value).cast(star.fact.schema[column].dataType)
    cols = [c for c in ("order_id", "line_number", "order_date", "customer_id", "product_id", "quantity") if c in star.fact.columns]
    return star.fact.filter(F.col(column) == key).select(
        *cols, money_out("sales_amount").alias("sales_amount"), money_out("profit").alias("profit"))


def order_lines(star: Star, order_id) -> DataFrame:
    """P7 on facts: the lines of one order."""
    return _lines_by_id(star, "order_id", order_id)


def customer_lines(star: Star, customer_id) -> DataFrame:
    """P7 on facts: the lines of one customer."""
    return _lines_by_id(star, "customer_id", customer_id)


def bound_product_lookup(star: Star, product_id: int) -> DataFrame:
    """The product lookup as SQL with a bound parameter."""
    return star.product.sparkSession.sql(
        "SELECT CAST(unit_cost AS DOUBLE) AS unit_cost, category FROM {product} WHERE product_id = :id",
        args={"id": product_id}, product=star.product)


def distinct_categories(star: Star) -> DataFrame:
    """Sorted category domain."""
    return star.product.select("category").distinct().orderBy("category")


def distinct_countries(star: Star) -> DataFrame:
    """Sorted country domain."""
    return star.customer.select("country").distinct().orderBy("country")


def pick_list_products(star: Star) -> DataFrame:
    """(id, name) of every product sorted by name."""
    return star.product.select("product_id", "product_name").orderBy("product_name", "product_id")


def pick_list_customers(star: Star) -> DataFrame:
    """(id, name) of every customer sorted by name."""
    return star.customer.select("customer_id", "customer_name").orderBy("customer_name", "customer_id")
