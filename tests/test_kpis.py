"""Invariants of the views and edge fixtures."""

import math
from decimal import Decimal as D


from starkpi.operators.filters import SalesFilter
from starkpi.plans import dashboard, explorer, kpis, trends
from tests.fixtures import line, small_star


def _total(df, col):
    return sum(D(str(r[0])) for r in df.select(col).collect() if r[0] is not None)


def test_revenue_adds_up_across_views(star):
    total = D(str(kpis.kpi_summary(star).first()["total_revenue"]))
    for df, col in [(kpis.category_performance(star), "total_revenue"),
                    (kpis.regional_performance(star), "total_revenue"),
                    (kpis.customer_rfm(star), "monetary_value"),
                    (kpis.product_performance(star), "total_revenue"),
                    (kpis.monthly_revenue(star), "total_revenue")]:
        assert _total(df, col) == total


def test_distinct_orders_do_not_roll_up(spark):
    # one order over two countries and two categories
    s = small_star(spark, [line(1, 1, 1, 1, "2024-01-05", 1, 10, 0, 10, 0),
                           line(1, 2, 2, 2, "2024-01-05", 1, 50, 0, 50, 0)])
    assert kpis.kpi_summary(s).first()["total_orders"] == 1
    assert sum(r["order_count"] for r in kpis.regional_performance(s).collect()) == 2
    assert sum(r["order_count"] for r in kpis.category_performance(s).collect()) == 2


def test_empty_fact_gives_one_null_row(spark):
    s = small_star(spark, [])
    r = kpis.kpi_summary(s).collect()
    assert len(r) == 1 and r[0]["total_orders"] == 0 and r[0]["total_revenue"] is None
    assert r[0]["margin_pct"] is None and r[0]["avg_order_value"] is None


def test_fact_outside_calendar_only_in_total(spark):
    s = small_star(spark, [line(1, 1, 1, 1, "2024-03-01", 1, 10, 0, 10, 1),
                           line(2, 1, 1, 1, "2026-07-03", 1, 20, 0, 20, 2)])
    assert kpis.kpi_summary(s).first()["total_revenue"] == 30.0
    assert _total(kpis.monthly_revenue(s), "total_revenue") == D("10.0")


def test_tied_products_share_rank(spark):
    s = small_star(spark, [line(1, 1, 1, 1, "2024-01-01", 1, 10, 0, 100, 1),
                           line(2, 1, 2, 1, "2024-01-01", 1, 10, 0, 100, 1),
                           line(3, 1, 3, 1, "2024-01-01", 1, 10, 0, 50, 1)])
    ranks = {r["product_name"]: r["revenue_rank"] for r in kpis.product_performance(s).collect()}
    assert ranks == {"Widget": 1, "Chair": 1, "Unsold": 3}


def test_homonyms_merge_in_top_customers_not_in_rfm(spark):
    s = small_star(spark, [line(1, 1, 1, 1, "2024-01-01", 1, 10, 0, 10, 1),
                           line(2, 1, 1, 2, "2024-01-02", 1, 10, 0, 20, 1)])
    top = dashboard.dash_top_customers(s, SalesFilter()).collect()
    assert [(r["customer_name"], r["lifetime_value"], r["order_count"]) for r in top] == [("Anna Brown", 30.0, 2)]
    assert kpis.customer_rfm(s).count() == 2


def test_zero_sales_line_margin(spark):
    s = small_star(spark, [line(1, 1, 1, 1, "2024-01-01", 1, 10, 0, 0, -5)])
    row = explorer.explore_sales(s, SalesFilter()).first()
    assert row["margin_pct"] == 0.0
    assert kpis.category_performance(s).first()["margin_pct"] is None


def test_unsold_product_and_customer_without_sales(spark):
    s = small_star(spark, [line(1, 1, 1, 1, "2024-01-01", 2, 10, 0, 20, 4)])
    prods = {r["product_name"]: r.asDict() for r in explorer.explore_products(s, SalesFilter()).collect()}
    assert prods["Unsold"]["times_sold"] == 1 and prods["Unsold"]["units_sold"] is None
    assert prods["Unsold"]["total_revenue"] is None and prods["Unsold"]["avg_margin"] == 0.0
    assert prods["Widget"]["times_sold"] == 1 and prods["Widget"]["avg_margin"] == 20.0
    cust = {r["country"] + r["customer_name"]: r.asDict() for r in explorer.explore_customers(s, SalesFilter()).collect()}
    assert cust["JapanNo Sales"]["total_orders"] == 0 and cust["JapanNo Sales"]["total_spent"] is None


def test_empty_filter_lists_mean_no_filter(spark, star):
    a = dashboard.dash_kpis(star, SalesFilter()).first()
    b = kpis.kpi_summary(star).first()
    assert a["total_revenue"] == b["total_revenue"] and a["total_orders"] == b["total_orders"]


def test_growth_is_null_without_previous_period(spark):
    s = small_star(spark, [line(1, 1, 1, 1, "2024-01-10", 1, 10, 0, 100, 1),
                           line(2, 1, 1, 1, "2024-03-10", 1, 10, 0, 150, 1),
                           line(3, 1, 1, 1, "2024-04-10", 1, 10, 0, 300, 1)], years=1)
    g = {(r["month"]): r["mom_growth_pct"] for r in trends.monthly_growth(s).collect()}
    assert g[1] is None and g[3] is None and g[4] == 100.0


def test_pareto_running_total_reaches_100(star):
    rows = trends.product_pareto(star).orderBy("revenue_rank", "product_name", "category", "sub_category").collect()
    assert math.isclose(rows[-1]["cumulative_pct"], 100.0)
    run = [r["running_revenue"] for r in rows]
    assert run == sorted(run)


def test_share_sums_to_100(star):
    shares = [r["share_pct"] for r in kpis.category_share(star).collect()]
    assert abs(sum(shares) - 100.0) < 0.05


def test_explorer_merges_homonyms_with_and_without_sales(spark):
    from tests.fixtures import small_star as mk
    customers = [(1, "Ivy Ito", "Consumer", "Japan", "Asia Pacific"),
                 (2, "Ivy Ito", "Consumer", "Japan", "Asia Pacific"),   # same group, no sales
                 (3, "Lone", "Consumer", "Japan", "Asia Pacific")]      # no sales at all
    s = mk(spark, [line(1, 1, 1, 1, "2024-01-01", 1, 10, 0, 10, 1),
                   line(1, 2, 2, 1, "2024-01-01", 1, 10, 0, 30, 1),
                   line(2, 1, 1, 1, "2024-01-02", 1, 10, 0, 20, 1)], customers=customers)
    got = {r["customer_name"]: r.asDict() for r in explorer.explore_customers(s, SalesFilter()).collect()}
    assert got["Ivy Ito"]["total_orders"] == 2 and got["Ivy Ito"]["total_spent"] == 60.0
    assert got["Ivy Ito"]["avg_order"] == 20.0
    assert got["Lone"]["total_orders"] == 0 and got["Lone"]["total_spent"] is None
    assert got["Lone"]["last_purchase"] is None


def test_persisted_star_gives_same_answers(star):
    from starkpi.catalog import DASH_FILTER
    cached = star.persist()
    try:
        assert kpis.kpi_summary(cached).first() == kpis.kpi_summary(star).first()
        assert dashboard.dash_kpis(cached, DASH_FILTER).first() == dashboard.dash_kpis(star, DASH_FILTER).first()
        assert cached.calendar_spans_fact and cached.fact.storageLevel.useDisk
    finally:
        cached.unpersist()


def test_hot_customer_is_split_by_aqe(spark, star):
    """A customer holding a third of all lines: the customer explorer's inner
    join is split by AQE (skew=true in the final plan), result unchanged."""
    import contextlib
    import io as _io
    from pyspark.sql import functions as F2
    hot = star.with_fact(star.fact.withColumn(
        "customer_id", F2.when(F2.col("order_id") % 3 == 0, F2.lit(1)).otherwise(F2.col("customer_id"))))
    want = sorted(map(tuple, explorer.explore_customers(hot, SalesFilter()).collect()))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = explorer.explore_customers(hot, SalesFilter())
        got = sorted(map(tuple, df.toPandas().itertuples(index=False, name=None)))
        buf = _io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        assert "SortMergeJoin(skew=true)" in buf.getvalue().split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    norm = lambda rows: [tuple(None if x != x else x for x in r) for r in rows]
    assert norm(got) == norm(want)
