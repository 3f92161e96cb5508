"""Line-level and housekeeping queries over a star: cleaning runs, quality
reports, calendar, pricing, labels, display cards, table status and the
plain star join.  Money leaves as double, as everywhere else.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from starkpi.functions import formatting as fmt
from starkpi.functions.calendar import month_label
from starkpi.functions.numeric import money_out
from starkpi.functions.pricing import (MANUAL_DEFAULT_MARGIN, line_profit, manual_order_id, manual_profit,
                                       manual_revenue, manual_unit_price, order_label,
                                       sales_amount, ship_date, ship_lag_days)
from starkpi.operators import clean, quality
from starkpi.operators.bitmaps import distinct_counts, id_bitmaps
from starkpi.operators.filters import SalesFilter, default_filter_for
from starkpi.plans.dashboard import dash_countries, dash_kpis, filtered_sales
from starkpi.plans.explorer import distinct_countries
from starkpi.plans.kpis import monthly_revenue
from starkpi.sources.star import Star

LINE_KEY = ["order_id", "line_number"]
# "First copy" order inside one line key: every other column, in this order.
LINE_FIRST = ["product_id", "supplier_id", "customer_id", "order_date", "ship_date", "quantity",
              "unit_price", "discount", "sales_amount", "profit"]


def money_to_double(df: DataFrame) -> DataFrame:
    """Cast every decimal column to double (the output edge)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


# ---- cleaning on the star's raw fact lines -------------------------------

def dedup_lines(star: Star) -> DataFrame:
    """C1 on fact lines keyed by (order_id, line_number)."""
    return money_to_double(clean.dedup_first(star.fact, LINE_KEY, LINE_FIRST))


def recomputed_lines(star: Star) -> DataFrame:
    """C4 on fact lines: sales_amount from quantity, unit price, discount."""
    return money_to_double(clean.recompute_sales_amount(star.fact).select(
        *LINE_KEY, "product_id", "supplier_id", "quantity", "unit_price", "discount", "sales_amount"))


def clean_lines(star: Star) -> DataFrame:
    """C6 on fact lines."""
    return money_to_double(clean.clean_fact(star.fact, LINE_KEY, LINE_FIRST))


def clean_lines_report(star: Star) -> DataFrame:
    """C5 on fact lines."""
    return clean.clean_report(star.fact, LINE_KEY, LINE_FIRST)


def clean_products(star: Star) -> DataFrame:
    """C7 on the product dimension."""
    return money_to_double(clean.clean_dimension(star.product, "product_id"))


# ---- quality reports ----------------------------------------------------

def star_null_counts(star: Star) -> DataFrame:
    """C8 over the four star tables."""
    return quality.union_all([
        quality.null_counts(star.fact, "fact_sales"),
        quality.null_counts(star.product, "dim_product"),
        quality.null_counts(star.customer, "dim_customer"),
        quality.null_counts(star.date, "dim_date")])


def star_duplicate_keys(star: Star) -> DataFrame:
    """Duplicated primary keys of the four star tables (the fact line
    key is (order_id, line_number))."""
    return quality.union_all([
        quality.duplicate_keys(star.fact, "fact_sales", LINE_KEY),
        quality.duplicate_keys(star.product, "dim_product", ["product_id"]),
        quality.duplicate_keys(star.customer, "dim_customer", ["customer_id"]),
        quality.duplicate_keys(star.date, "dim_date", ["date_id"])])


def star_orphans(star: Star, lines: DataFrame | None = None) -> DataFrame:
    """Orphan counts of every foreign key of the fact.  ``lines`` are
    fact rows *before* any inner join to a dimension (so orphans are still
    visible); by default the star's own fact."""
    f = lines if lines is not None else star.fact
    return quality.orphan_report(f, [
        ("fact_sales.order_date -> dim_date", star.date, "order_date", "date_id"),
        ("fact_sales.customer_id -> dim_customer", star.customer, "customer_id", "customer_id"),
        ("fact_sales.product_id -> dim_product", star.product, "product_id", "product_id")])


# ---- derived columns ----------------------------------------------------

def calendar_table(star: Star) -> DataFrame:
    """The star's calendar."""
    return star.date.orderBy("date_id")


def line_pricing(star: Star) -> DataFrame:
    """per line, sales amount and profit from quantity, unit price,
    discount and the product's unit cost."""
    j = star.fact_products()
    sa = sales_amount("quantity", "unit_price", "discount")
    return j.select(*LINE_KEY, "product_id", "supplier_id", "quantity",
                    money_out("unit_price").alias("unit_price"),
                    F.col("discount").cast("double").alias("discount"),
                    money_out(sa).alias("sales_amount"),
                    money_out(line_profit(sa, "quantity", "unit_cost")).alias("profit"))


def ship_lag(star: Star) -> DataFrame:
    """F10 inverse: number of lines per shipping lag in days."""
    return (star.fact.groupBy(ship_lag_days("order_date", "ship_date").alias("lag_days"))
            .agg(F.count(F.lit(1)).alias("lines")).orderBy("lag_days"))


def ship_dates(star: Star) -> DataFrame:
    """per line, the ship date that a lag of one to seven days gives."""
    return star.fact.select(*LINE_KEY, "product_id", "supplier_id", "quantity",
                            ship_date("order_date", F.col("quantity") % 7 + 1).alias("ship_date"))


def manual_order_ids(star: Star) -> DataFrame:
    """the id that a manual sale entered at the start of each order date would get."""
    entered = F.timestamp_seconds(F.unix_date("order_date") * 86400)
    return star.fact.select("order_date").distinct().select("order_date", manual_order_id(entered).alias("order_id"))


def orders_by_period(star: Star) -> DataFrame:
    """A3: distinct orders of every year and in all, rolled up from one bitmap a month."""
    month = F.trunc("order_date", "month")
    monthly = id_bitmaps(star.fact.withColumn("order_month", month), "order_id", ["order_month"])
    years = distinct_counts(monthly.withColumn("period", F.year("order_month").cast("string")), ["period"], "order_count")
    return years.unionByName(distinct_counts(monthly.withColumn("period", F.lit("all")), ["period"], "order_count"))


def default_filter_countries(star: Star, start: str, today: str) -> DataFrame:
    """Revenue by country under the dashboard's initial filter."""
    flt = default_filter_for(distinct_countries(star), today=_dt.date.fromisoformat(today), default_start=_dt.date.fromisoformat(start))
    return dash_countries(star, flt)


def order_labels(star: Star) -> DataFrame:
    """``ORD-000123`` label of every order."""
    return (star.fact.select("order_id").distinct()
            .select("order_id", order_label("order_id").alias("order_label")))


def manual_sale_pricing(star: Star, quantity: int = 1, margin_pct: int = MANUAL_DEFAULT_MARGIN) -> DataFrame:
    """what the manual-entry form proposes for each product: unit price
    = cost x 1.5, revenue = quantity x unit price, profit = revenue x margin."""
    up = manual_unit_price("unit_cost")
    rev = manual_revenue(F.lit(quantity), up)
    return star.product.select(
        "product_id", money_out(up).alias("unit_price"), F.lit(quantity).cast("int").alias("quantity"),
        money_out(rev).alias("revenue"), money_out(manual_profit(rev, F.lit(margin_pct))).alias("profit"))


def monthly_series(star: Star) -> DataFrame:
    """monthly revenue with its ``YYYY-MM`` label."""
    return monthly_revenue(star).select(month_label().alias("month_label"), "year", "month",
                                        "total_revenue", "total_profit")


def kpi_cards(star: Star, flt: SalesFilter) -> DataFrame:
    """the dashboard's KPI tiles as display text."""
    k = dash_kpis(star, flt)
    return k.select(fmt.currency("total_revenue", 0).alias("revenue_card"),
                    fmt.currency("total_profit", 0).alias("profit_card"),
                    fmt.number("total_orders", 0).alias("orders_card"),
                    fmt.currency("avg_order", 2).alias("avg_order_card"),
                    fmt.percent("avg_margin", 1).alias("margin_card"))


def star_status(star: Star) -> DataFrame:
    """Row count of each star table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in [("fact_sales", star.fact), ("dim_product", star.product),
                              ("dim_customer", star.customer), ("dim_date", star.date)]]
    return quality.union_all(parts)


def filtered_lines(star: Star, flt: SalesFilter) -> DataFrame:
    """The lines that pass a dashboard filter, with names."""
    s = filtered_sales(star, flt)
    return s.select(*LINE_KEY, "order_date", "product_name", "category", "customer_name", "country",
                    "quantity", money_out("sales_amount").alias("sales_amount"),
                    money_out("profit").alias("profit"))


def star_join(star: Star) -> DataFrame:
    """Every fact line with its product and customer attributes."""
    return money_to_double(star.sales())
