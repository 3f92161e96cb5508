"""Registry of runnable queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query derives its star from the given test tables, so its work grows
with them.  Parameters below are the feature's own inputs (a dashboard
filter, a benchmark month, a top-k size, a looked-up key), fixed here so
that each run is reproducible and comparable with ``oracle.ORACLE``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from starkpi.operators.filters import SalesFilter
from starkpi.plans import dashboard, explorer, kpis, lines, rollups, trends
from starkpi.plans.dirty import TEXT_COLUMNS, dirty_star
from starkpi.sources import io
from starkpi.sources.star import Star, raw_lines

# Fixed parameters of the registered queries.
DASH_FILTER = SalesFilter("1996-01-01", "1998-12-31", ("ECONOMY", "PROMO"),
                          ("NATION_0", "NATION_1", "NATION_2", "NATION_3", "NATION_4"))
BENCH_MONTH = ("1996-06-01", "1996-06-30")
LOOKUP_PRODUCT_ID = 42
LOOKUP_ORDER_ID = 7
LOOKUP_CUSTOMER_ID = 10
DEFAULT_FILTER_DATES = ("1996-01-01", "1998-12-31")

Query = Callable[[SparkSession, str], DataFrame]


def iso_dates(df: DataFrame) -> DataFrame:
    """Date columns as ``yyyy-MM-dd`` text, the source system's own date
    representation (its dates are ISO text); the library keeps DateType."""
    return df.select(*[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, DateType)
                       else F.col(f.name) for f in df.schema.fields])


def _registered(q: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return iso_dates(q(spark, sf_dir))
    run.__name__ = getattr(q, "__name__", "query")
    return run


def _on_star(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Star.from_testdata(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


QUERIES: dict[str, Query] = {
    # six views and reports
    "kpi_summary": _on_star(kpis.kpi_summary),
    "monthly_revenue": _on_star(kpis.monthly_revenue),
    "product_performance": _on_star(kpis.product_performance),
    "category_performance": _on_star(kpis.category_performance),
    "regional_performance": _on_star(kpis.regional_performance),
    "customer_rfm": _on_star(kpis.customer_rfm),
    "top_products": _on_star(lambda s: kpis.top_products(s, 10)),
    "top_customers_rfm": _on_star(lambda s: kpis.top_customers_rfm(s, 10)),
    "last_months": _on_star(lambda s: kpis.last_months(s, 6)),
    "top_margin_products": _on_star(lambda s: kpis.top_margin_products(s, 10)),
    "category_share": _on_star(kpis.category_share),
    "country_share": _on_star(lambda s: kpis.country_share(s, DASH_FILTER)),
    # advertised trends
    "product_pareto": _on_star(trends.product_pareto),
    "monthly_growth": _on_star(trends.monthly_growth),
    "weekend_revenue": _on_star(trends.weekend_revenue),
    "yearly_growth": _on_star(trends.yearly_growth),
    # dashboard
    "dash_kpis": _on_star(lambda s: dashboard.dash_kpis(s, DASH_FILTER)),
    "dash_daily_trend": _on_star(lambda s: dashboard.dash_daily_trend(s, DASH_FILTER)),
    "dash_categories": _on_star(lambda s: dashboard.dash_categories(s, DASH_FILTER)),
    "dash_top_products": _on_star(lambda s: dashboard.dash_top_products(s, DASH_FILTER)),
    "dash_countries": _on_star(lambda s: dashboard.dash_countries(s, DASH_FILTER)),
    "dash_top_customers": _on_star(lambda s: dashboard.dash_top_customers(s, DASH_FILTER)),
    # explorer and benchmark
    "explore_sales": _on_star(lambda s: explorer.explore_sales(s, DASH_FILTER)),
    "explore_sales_totals": _on_star(lambda s: explorer.explore_sales_totals(s, DASH_FILTER)),
    "explore_customers": _on_star(lambda s: explorer.explore_customers(s, DASH_FILTER)),
    "explore_products": _on_star(lambda s: explorer.explore_products(s, DASH_FILTER)),
    "bench_month_product": _on_star(lambda s: explorer.bench_month_product(s, *BENCH_MONTH)),
    # pick lists and lookups
    "product_lookup": _on_star(lambda s: explorer.product_lookup(s, LOOKUP_PRODUCT_ID)),
    "bound_product_lookup": _on_star(lambda s: explorer.bound_product_lookup(s, LOOKUP_PRODUCT_ID)),
    "order_lookup": _on_star(lambda s: explorer.order_lines(s, LOOKUP_ORDER_ID)),
    "customer_lookup": _on_star(lambda s: explorer.customer_lines(s, LOOKUP_CUSTOMER_ID)),
    "distinct_categories": _on_star(explorer.distinct_categories),
    "distinct_countries": _on_star(explorer.distinct_countries),
    "pick_list_products": _on_star(explorer.pick_list_products),
    "pick_list_customers": _on_star(explorer.pick_list_customers),
    # cleaning and quality
    "clean_dedup": _on_star(lines.dedup_lines),
    "recompute_sales_amount": _on_star(lines.recomputed_lines),
    "clean_report": _on_star(lines.clean_lines_report),
    "clean_fact": _on_star(lines.clean_lines),
    "clean_dimension": _on_star(lines.clean_products),
    "dq_not_null": _on_star(lines.star_null_counts),
    "dq_duplicate_keys": _on_star(lines.star_duplicate_keys),
    "dq_orphans": lambda spark, d: lines.star_orphans(
        Star.from_testdata(spark, d), raw_lines(spark, d)),
    # derived columns and housekeeping
    "calendar": _on_star(lines.calendar_table),
    "line_pricing": _on_star(lines.line_pricing),
    "ship_lag": _on_star(lines.ship_lag),
    "ship_dates": _on_star(lines.ship_dates),
    "manual_order_ids": _on_star(lines.manual_order_ids),
    "orders_by_period": _on_star(lines.orders_by_period),
    "default_filter_countries": _on_star(lambda s: lines.default_filter_countries(s, *DEFAULT_FILTER_DATES)),
    "order_label": _on_star(lines.order_labels),
    "manual_sale_pricing": _on_star(lines.manual_sale_pricing),
    "monthly_series": _on_star(lines.monthly_series),
    "kpi_cards": _on_star(lambda s: lines.kpi_cards(s, DASH_FILTER)),
    "table_status": _on_star(lines.star_status),
    "filtered_lines": _on_star(lambda s: lines.filtered_lines(s, DASH_FILTER)),
    "star_join": _on_star(lines.star_join),
    # static page slices of the export
    "page_products": _on_star(io.page_products),
    "page_customers": _on_star(io.page_customers),
}

# The same queries over the dirtied star, where their checks have something to find.
_DIRTY = {
    "monthly_revenue": kpis.monthly_revenue,
    "clean_dedup": lines.dedup_lines,
    "clean_report": lines.clean_lines_report,
    "clean_fact": lines.clean_lines,
    "clean_dimension": lines.clean_products,
    "dq_not_null": lines.star_null_counts,
    "dq_duplicate_keys": lines.star_duplicate_keys,
    "dq_orphans": lines.star_orphans,
    "explore_customers": lambda s: explorer.explore_customers(s, DASH_FILTER),
    "explore_products": lambda s: explorer.explore_products(s, DASH_FILTER),
}

# The views from monthly rollups, without their table: what a refresh writes, as one plan.
_ROLLED = {f"rollup_{name}": lambda s, view=view: view(rollups.rolled(s)) for name, view in rollups.VIEWS.items()}
QUERIES.update({name: _on_star(fn) for name, fn in _ROLLED.items()})
_DIRTY.update(_ROLLED)


def _on_dirty_star(name: str, fn) -> Query:
    def run(star: Star) -> DataFrame:
        df = fn(dirty_star(star))
        return df.select(*[F.col(c).cast("string").alias(c) if c in TEXT_COLUMNS.get(name, []) else F.col(c)
                           for c in df.columns])
    return _on_star(run)


QUERIES.update({f"dirty_{name}": _on_dirty_star(name, fn) for name, fn in _DIRTY.items()})

QUERIES = {name: _registered(q) for name, q in QUERIES.items()}
