"""The six KPI views (V1-V6) and the reports built on them.

Scale notes
- Aggregates that are decomposable are computed on the fact *before* joining
  a growing dimension (``eager aggregation``): product performance sums by
  product_id first, so the join sees one row per product, not one per line.
  Catalyst does not push aggregates below joins by itself.
- Distinct order counts are never rolled up from finer groups; Spark plans
  them as (group, order_id) partial aggregates, so a hot group is spread
  over its orders instead of landing in one task.
- Ranks and running totals use ``operators.ordered`` (no single-task window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starkpi.functions.numeric import money_out, pct, ratio
from starkpi.operators.ordered import rank_desc, rank_of, shared, top_k
from starkpi.sources.star import Star


def kpi_summary(star: Star) -> DataFrame:
    """V1: one row of totals; margin guarded, average order per distinct order."""
    f = star.fact
    return f.agg(
        F.sum("sales_amount").alias("_rev"), F.sum("profit").alias("_pro"),
        F.count_distinct("order_id").alias("total_orders"),
    ).select(
        money_out("_rev").alias("total_revenue"),
        money_out("_pro").alias("total_profit"),
        pct("_pro", "_rev").alias("margin_pct"),
        F.col("total_orders"),
        ratio("_rev", "total_orders").alias("avg_order_value"))


def monthly_revenue(star: Star) -> DataFrame:
    """V2: revenue, profit and distinct orders per calendar month (facts whose
    date is not in the calendar are dropped by the inner join)."""
    return (star.fact_calendar()
            .groupBy("year", "month", "month_name")
            .agg(money_out(F.sum("sales_amount")).alias("total_revenue"),
                 money_out(F.sum("profit")).alias("total_profit"),
                 F.count_distinct("order_id").alias("order_count"))
            .orderBy("year", "month"))


def _product_totals(star: Star) -> DataFrame:
    """Per (product_name, category, sub_category) exact sums, pre-aggregated
    by product_id before the product join."""
    return (star.product_sums()
            .groupBy("product_name", "category", "sub_category")
            .agg(F.sum("_rev").alias("_rev"), F.sum("_pro").alias("_pro"),
                 F.sum("_qty").cast("long").alias("units_sold")))


_PRODUCT_KEYS = ["product_name", "category", "sub_category"]


def _by_revenue() -> list:
    return [F.col("total_revenue").desc(), *map(F.col, _PRODUCT_KEYS)]


def product_performance(star: Star) -> DataFrame:
    """V3 + W1: totals per product name/category/sub-category with
    RANK() over descending revenue (ties share a rank, the next is skipped),
    by revenue descending."""
    ranked = rank_desc(_product_totals(star), "_rev", _PRODUCT_KEYS, "revenue_rank")
    return _product_out(ranked, "revenue_rank").orderBy(*_by_revenue())


def product_list(star: Star) -> DataFrame:
    """V3 without the rank, unsorted: what the export and its page show."""
    return _product_out(_product_totals(star))


def _product_out(totals: DataFrame, *more: str) -> DataFrame:
    return totals.select(*_PRODUCT_KEYS, money_out("_rev").alias("total_revenue"),
                         money_out("_pro").alias("total_profit"), "units_sold", *more)


def category_performance(star: Star) -> DataFrame:
    """V4: revenue, profit, guarded margin and distinct orders per category, by
    revenue descending."""
    return (star.fact_products()
            .groupBy("category")
            .agg(F.sum("sales_amount").alias("_rev"), F.sum("profit").alias("_pro"),
                 F.count_distinct("order_id").alias("order_count"))
            .select("category", money_out("_rev").alias("total_revenue"),
                    money_out("_pro").alias("total_profit"),
                    pct("_pro", "_rev").alias("margin_pct"), "order_count")
            .orderBy(F.col("total_revenue").desc(), "category"))


def regional_performance(star: Star) -> DataFrame:
    """V5: revenue, distinct orders and revenue per distinct order by
    region and country, by revenue descending."""
    return (star.fact_customers()
            .groupBy("region", "country")
            .agg(F.sum("sales_amount").alias("_rev"),
                 F.count_distinct("order_id").alias("order_count"))
            .select("region", "country", money_out("_rev").alias("total_revenue"),
                    "order_count", ratio("_rev", "order_count").alias("avg_order_value"))
            .orderBy(F.col("total_revenue").desc(), "region", "country"))


def customer_rfm(star: Star) -> DataFrame:
    """V6: last order date, distinct orders and revenue per customer id, by
    revenue descending.
    Grouped by the key first (the key determines name and segment), then
    joined to the customer attributes."""
    per_id = star.fact.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count_distinct("order_id").alias("frequency"),
        F.sum("sales_amount").alias("_rev"))
    return per_id.join(star.customer, "customer_id").select(
        "customer_id", "customer_name", "segment", "last_order_date", "frequency",
        money_out("_rev").alias("monetary_value")).orderBy(F.col("monetary_value").desc(), "customer_id")


# ---- reports over the views ---------------------------------------------

def top_products(star: Star, n: int = 10) -> DataFrame:
    """O3: first ``n`` rows of product performance by revenue.  Whatever sells
    more than one of them is among them, so their ranks need no other row."""
    first = top_k(_product_totals(star), n, [F.col("_rev").desc(), *map(F.col, _PRODUCT_KEYS)])
    ranked = first.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.col("_rev").desc())).cast("int"))
    return _product_out(ranked, "revenue_rank").orderBy(*_by_revenue())


def top_customers_rfm(star: Star, n: int = 10) -> DataFrame:
    """O3: first ``n`` customers by monetary value."""
    return top_k(customer_rfm(star), n, [F.col("monetary_value").desc(), F.col("customer_id")])


def last_months(star: Star, n: int = 6) -> DataFrame:
    """The last ``n`` months of the monthly trend, shown ascending."""
    m = monthly_revenue(star)
    return top_k(m, n, [F.col("year").desc(), F.col("month").desc()]).orderBy("year", "month")


def top_margin_products(star: Star, n: int = 10) -> DataFrame:
    """Products by margin = total_profit / total_revenue * 100."""
    totals = shared(_product_totals(star))
    margin = pct(money_out("_pro"), money_out("_rev"))
    order = [F.col("margin_pct").desc_nulls_last(), *map(F.col, _PRODUCT_KEYS)]
    best = top_k(totals.withColumn("margin_pct", margin), n, order)
    return _product_out(rank_of(totals, "_rev", best, "revenue_rank"), "revenue_rank", "margin_pct").orderBy(*order)


def share_of_total(df: DataFrame, value_col: str, out_col: str = "share_pct") -> DataFrame:
    """Each row's share of the column total, in percent.  For results of
    few rows (one per category or country), which the window holds at once."""
    total = F.sum(value_col).over(Window.partitionBy())
    return df.withColumn(out_col, pct(F.col(value_col), total))


def category_share(star: Star) -> DataFrame:
    """Category revenue share (pie chart of the notebook), from exact sums
    per product, so one row per product meets the dimension."""
    c = star.product_sums().groupBy("category").agg(F.sum("_rev").alias("_rev"))
    return share_of_total(c, "_rev").select(
        "category", money_out("_rev").alias("total_revenue"), "share_pct")


def country_share(star: Star, flt=None) -> DataFrame:
    """Country revenue share (pie chart of the dashboard; date and
    country filters only), from exact sums per customer."""
    fact, customer = star.fact, star.customer
    if flt is not None:
        fact = fact.filter(star.date_predicate(flt, categories=False, countries=False))
        if flt.country_predicate() is not None:
            customer = customer.filter(flt.country_predicate())
    per = fact.groupBy("customer_id").agg(F.sum("sales_amount").alias("_rev"))
    c = per.join(customer, "customer_id").groupBy("country").agg(F.sum("_rev").alias("_rev"))
    return share_of_total(c, "_rev").select(
        "country", money_out("_rev").alias("revenue"), "share_pct")


def kpi_report(star: Star) -> dict[str, DataFrame]:
    """The printed KPI report as DataFrames (summary, last six months,
    top products, categories, regions, top customers)."""
    return {
        "summary": kpi_summary(star),
        "last_months": last_months(star, 6),
        "top_products": top_products(star, 10),
        "categories": category_performance(star),
        "regions": regional_performance(star),
        "top_customers": top_customers_rfm(star, 10),
    }
