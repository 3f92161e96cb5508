"""Filtered dashboard queries.

Each takes a ``SalesFilter``; as on the reference dashboard, the country and
top-customer queries ignore the category filter.  "orders" in D4-D6 counts
lines (COUNT(*)), while D1's total_orders counts distinct orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkpi.functions.numeric import money_out, pct, ratio
from starkpi.operators.filters import SalesFilter
from starkpi.operators.ordered import top_k
from starkpi.sources.star import Star


def filtered_sales(star: Star, flt: SalesFilter) -> DataFrame:
    """P6 + J4: star-joined lines passing every set filter."""
    return star.sales().filter(star.date_predicate(flt))


def dash_kpis(star: Star, flt: SalesFilter) -> DataFrame:
    """Revenue, profit (unrounded), distinct orders, average line value,
    and margin as AVG(profit)/AVG(sales) (= sum ratio over the same lines)."""
    s = filtered_sales(star, flt)
    return s.agg(F.sum("sales_amount").alias("_rev"), F.sum("profit").alias("_pro"),
                  F.count_distinct("order_id").alias("total_orders"),
                  F.count("sales_amount").alias("_n")).select(
        money_out("_rev").alias("total_revenue"), money_out("_pro").alias("total_profit"),
        "total_orders", ratio("_rev", "_n").alias("avg_order"),
        pct("_pro", "_rev").alias("avg_margin"))


def dash_daily_trend(star: Star, flt: SalesFilter) -> DataFrame:
    """Revenue and profit per day, ascending."""
    return (filtered_sales(star, flt).groupBy(F.col("order_date").alias("date"))
            .agg(money_out(F.sum("sales_amount")).alias("revenue"),
                 money_out(F.sum("profit")).alias("profit"))
            .orderBy("date"))


def dash_categories(star: Star, flt: SalesFilter) -> DataFrame:
    """D3: revenue per category, descending."""
    return (filtered_sales(star, flt).groupBy("category")
            .agg(money_out(F.sum("sales_amount")).alias("revenue"))
            .orderBy(F.col("revenue").desc(), "category"))


def dash_top_products(star: Star, flt: SalesFilter, n: int = 10) -> DataFrame:
    """Top products by name: revenue and line count."""
    g = filtered_sales(star, flt).groupBy("product_name").agg(
        money_out(F.sum("sales_amount")).alias("revenue"), F.count(F.lit(1)).alias("orders"))
    return top_k(g, n, [F.col("revenue").desc(), F.col("product_name")])


def dash_countries(star: Star, flt: SalesFilter) -> DataFrame:
    """Revenue and line count by country (date and country filters only)."""
    j = star.fact_customers().filter(star.date_predicate(flt, categories=False))
    return (j.groupBy("country").agg(money_out(F.sum("sales_amount")).alias("revenue"),
                                     F.count(F.lit(1)).alias("orders"))
            .orderBy(F.col("revenue").desc(), "country"))


def dash_top_customers(star: Star, flt: SalesFilter, n: int = 15) -> DataFrame:
    """Top customers by (name, segment): lifetime value, line count and
    last order (date and country filters only; homonyms merge)."""
    j = star.fact_customers().filter(star.date_predicate(flt, categories=False))
    g = j.groupBy("customer_name", "segment").agg(
        money_out(F.sum("sales_amount")).alias("lifetime_value"),
        F.count(F.lit(1)).alias("order_count"), F.max("order_date").alias("last_order"))
    return top_k(g, n, [F.col("lifetime_value").desc(), F.col("customer_name"), F.col("segment")])
