"""Trends advertised by the reference but never computed there.

Month windows run over one row per calendar month (a bounded set), with a
RANGE frame on a month index so "previous month" / "same month last year"
means exactly that, and is NULL when that month has no sales.  The Pareto
running total uses ``operators.ordered`` (no single-task window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkpi.functions.calendar import month_index
from starkpi.functions.numeric import money_out, pct
from starkpi.operators.ordered import rank_desc, shared
from starkpi.plans.kpis import _PRODUCT_KEYS, _product_totals
from starkpi.sources.star import Star


def _monthly_exact(star: Star) -> DataFrame:
    return (star.fact_calendar().groupBy("year", "month")
            .agg(F.sum("sales_amount").alias("_rev"))
            .withColumn("_idx", month_index()))


def product_pareto(star: Star) -> DataFrame:
    """Products by descending revenue with running revenue and the
    cumulative share of total revenue (ties ordered by name keys)."""
    totals = shared(_product_totals(star))
    total = totals.select(F.sum("_rev")).scalar()
    ranked = rank_desc(totals, "_rev", _PRODUCT_KEYS, "revenue_rank", running={"_run": "_rev"},
                       already_shared=True)
    return ranked.select(*_PRODUCT_KEYS, money_out("_rev").alias("total_revenue"),
                         "revenue_rank", money_out("_run").alias("running_revenue"),
                         pct(F.col("_run"), total).alias("cumulative_pct"))


def monthly_growth(star: Star) -> DataFrame:
    """Month-over-month revenue growth in percent."""
    m = _monthly_exact(star)
    prev = F.sum("_rev").over(Window.orderBy("_idx").rangeBetween(-1, -1))
    return m.withColumn("_prev", prev).select(
        "year", "month", money_out("_rev").alias("total_revenue"),
        money_out("_prev").alias("prev_revenue"),
        pct(F.col("_rev") - F.col("_prev"), F.col("_prev")).alias("mom_growth_pct"))


def yearly_growth(star: Star) -> DataFrame:
    """Year-over-year growth of each month's revenue in percent."""
    m = _monthly_exact(star)
    prev = F.sum("_rev").over(Window.partitionBy("month").orderBy("year").rangeBetween(-1, -1))
    return m.withColumn("_prev", prev).select(
        "year", "month", money_out("_rev").alias("total_revenue"),
        money_out("_prev").alias("prev_year_revenue"),
        pct(F.col("_rev") - F.col("_prev"), F.col("_prev")).alias("yoy_growth_pct"))


def calendar_revenue(star: Star, where: Column) -> DataFrame:
    """Revenue and distinct orders per month, of the days that ``where`` selects by
    calendar attributes (``year``, ``quarter``, ``month``, ``day``, ``is_weekend``)."""
    return star.fact_calendar(where).groupBy("year", "month").agg(
        money_out(F.sum("sales_amount")).alias("total_revenue"),
        F.count_distinct("order_id").alias("order_count"))


def weekend_revenue(star: Star, quarter: int = 4) -> DataFrame:
    """``calendar_revenue`` of the weekends of one quarter in every year."""
    return calendar_revenue(star, (F.col("quarter") == quarter) & (F.col("is_weekend") == 1))
