"""Sources and sinks: CSV round trip, exports, logs, appends, status."""

import datetime as dt
import json
import os
from dataclasses import replace
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from starkpi import schema as S
from starkpi.sources import io, snapshots
from starkpi.plans import etl
from starkpi.sources.star import Star
from tests.conftest import SF_SMALL


def test_csv_round_trip_keeps_utf8(spark, tmp_out):
    rows = [(1, "Omar Müller", "Corporate", "Japan", "Asia Pacific"), (2, "Anna Brown", "Consumer", "France", "Europe")]
    df = spark.createDataFrame(rows, S.DIM_CUSTOMER)
    io.export_csv(df, tmp_out + "/c")
    back = io.read_csv(spark, tmp_out + "/c", S.DIM_CUSTOMER)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_csv_bad_date_becomes_null(spark, tmp_out):
    p = tmp_out + "/f.csv"
    with open(p, "w", encoding="utf-8") as f:
        f.write("line_id,order_id,order_date,customer_id,product_id,quantity,unit_price,discount\n")
        f.write("1,5,2024-01-01,1,1,2,10.00,0.10\n2,5,junk,1,1,2,10.00,0.10\n")
    df = io.read_csv(spark, p, S.FACT_SALES_INPUT)
    got = {r["line_id"]: r["order_date"] for r in df.collect()}
    assert got == {1: dt.date(2024, 1, 1), 2: None}


def test_export_document_is_one_json_object(spark, star, tmp_out):
    ds = io.dashboard_datasets(star)
    io.write_benchmark_log(spark, tmp_out + "/bench", {"avg": .0412, "min": .0401, "max": .0433},
                           {"avg": .0309, "min": .0288, "max": .0325}, 25.0)
    bench = io.parse_benchmark_log(spark, tmp_out + "/bench")
    from pyspark.sql import functions as F
    bench_json = bench.select(F.to_json(F.struct(*bench.columns)))
    io.export_document(spark, ds, tmp_out + "/doc", {"benchmark": bench_json})
    files = [f for f in os.listdir(tmp_out + "/doc") if f.startswith("part-")]
    text = "".join(open(os.path.join(tmp_out, "doc", f), encoding="utf-8").read() for f in files)
    doc = json.loads(text)
    assert set(doc) == {"kpi", "monthly", "products", "categories", "regional", "customers", "benchmark"}
    assert len(doc["kpi"]) == 1 and len(doc["products"]) <= 50 and len(doc["customers"]) <= 200
    revs = [r["total_revenue"] for r in doc["products"]]
    assert revs == sorted(revs, reverse=True)
    months = [(r["year"], r["month"]) for r in doc["monthly"]]
    assert months == sorted(months)
    assert doc["benchmark"]["without_avg_ms"] == 41.2 and doc["benchmark"]["with_avg_ms"] == 30.9
    assert doc["benchmark"]["speedup_pct"] == 25.0


def test_parse_benchmark_log_missing_numbers(spark, tmp_out):
    p = tmp_out + "/log.txt"
    with open(p, "w") as f:
        f.write("QUERY PERFORMANCE BENCHMARK\nWithout indexes: avg=88.2ms (min=80.1ms, max=97.4ms)\n")
    r = io.parse_benchmark_log(spark, p).first()
    assert r["without_avg_ms"] == 88.2 and r["with_avg_ms"] is None and r["speedup_pct"] is None
    assert r["raw"].startswith("QUERY PERFORMANCE")


def test_run_log_appends(spark, tmp_out):
    p = tmp_out + "/runlog"
    io.append_run_log(spark, p, dt.datetime(2024, 1, 1, 2, 0), 500, 2.5)
    io.append_run_log(spark, p, dt.datetime(2024, 1, 2, 2, 0), 600, 2.75)
    back = spark.read.option("header", True).csv(p)
    assert sorted(int(r["fact_rows_loaded"]) for r in back.collect()) == [500, 600]


def test_catalog_status_reports_missing(spark):
    spark.range(3).createOrReplaceTempView("tiny_status_view")
    got = {r["table_name"]: (r["row_count"], r["status"])
           for r in io.catalog_status(spark, ["tiny_status_view", "no_such_table"]).collect()}
    assert got == {"tiny_status_view": (3, "ok"), "no_such_table": (None, "missing")}


def test_pipeline_load_append_and_views(spark, tmp_out):
    star = Star.from_testdata(spark, SF_SMALL)
    root = tmp_out + "/star"
    rep = etl.run_pipeline(spark, star, root, log_path=tmp_out + "/log")
    assert rep["tables"]["fact_sales"]["rows"] == star.fact.count()
    assert "vw_kpi_summary" in rep["views"]
    lazy = spark.sql("SELECT * FROM vw_kpi_summary").first()
    from starkpi.plans import kpis
    # the load cleans (C4 recomputes sales_amount), so compare with the cleaned star
    assert lazy == kpis.kpi_summary(etl.clean_star(star, etl.TESTDATA_LINE_KEY)).first()
    # One manual sale, line_id and ship_date omitted
    sale = spark.createDataFrame(
        [(999999, dt.date(1996, 6, 15), 1, 1, 2, D("15.00"), D("0.00"), D("30.00"), D("12.00"), 777)],
        "order_id long, order_date date, customer_id long, product_id long, quantity int, "
        "unit_price decimal(18,2), discount decimal(4,2), sales_amount decimal(18,2), "
        "profit decimal(18,2), line_number int")
    io.append_sales(sale, snapshots.resolve(spark, root) + "/fact_sales", partition_by=["order_month"])
    loaded = Star.from_layout(spark, root)
    assert loaded.fact.count() == star.fact.count() + 1
    assert loaded.fact.filter("order_id = 999999 AND ship_date IS NULL").count() == 1


def test_killed_load_leaves_the_star_that_was_there(spark, star, tmp_out, monkeypatch):
    from starkpi.plans import kpis
    root = tmp_out + "/star"

    def dies(*args, **kwargs):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(etl, "fact_writer", dies)  # after the dimensions, before the fact
        with pytest.raises(RuntimeError):
            etl.run_pipeline(spark, star, root)
    with pytest.raises(Exception):
        Star.from_layout(spark, root)  # nothing was published
    etl.run_pipeline(spark, star, root)
    held = kpis.kpi_summary(Star.from_layout(spark, root))
    before = held.first()
    smaller = star.with_fact(star.fact.limit(10))
    smaller = replace(smaller, product=star.product.limit(3))
    with monkeypatch.context() as m:
        m.setattr(etl, "fact_writer", dies)
        with pytest.raises(RuntimeError):
            etl.run_pipeline(spark, smaller, root)
    again = Star.from_layout(spark, root)
    assert kpis.kpi_summary(again).first() == before and again.product.count() == star.product.count()
    etl.run_pipeline(spark, smaller, root)
    assert Star.from_layout(spark, root).fact.count() == 10
    assert held.first() == before  # a reader keeps the version it has resolved
    assert snapshots.current(spark, root).version == 2


def test_manual_sale_pricing_and_append(spark, star, tmp_out):
    from starkpi.plans.manual import ENTRY_DDL, manual_sales
    prod = star.product.filter("product_id = 42").first()
    entries = spark.createDataFrame(
        [(42, 1, 3, dt.date(1997, 2, 1), None, dt.datetime(2024, 5, 1, 12, 0, 0)),
         (42, 2, 1, dt.date(1997, 2, 2), 10, dt.datetime(2024, 5, 1, 12, 0, 0))], ENTRY_DDL)
    rows = {r["customer_id"]: r for r in manual_sales(entries, star.product).collect()}
    up = (prod["unit_cost"] * D("1.5")).quantize(D("0.01"))
    assert rows[1]["unit_price"] == up and rows[1]["sales_amount"] == up * 3
    assert rows[1]["profit"] == (up * 3 * D("0.4")).quantize(D("0.01"))
    assert rows[2]["profit"] == (up * D("0.1")).quantize(D("0.01"))
    assert rows[1]["order_id"] == rows[2]["order_id"]  # same second, same id
    assert rows[1]["order_id"] == "ORD" + str(int(dt.datetime(2024, 5, 1, 12, tzinfo=dt.timezone.utc).timestamp()))
    etl.load_star(etl.clean_star(star, etl.TESTDATA_LINE_KEY), tmp_out + "/star")
    io.append_sales(manual_sales(entries, star.product), tmp_out + "/star/fact_sales", partition_by=["order_month"])
    held = Star.from_layout(spark, tmp_out + "/star").fact
    assert held.filter("order_id LIKE 'ORD%'").count() == 2


def test_default_filter_first_five_countries(star):
    from starkpi.operators.filters import default_filter_for
    from starkpi.plans.explorer import distinct_countries
    f = default_filter_for(distinct_countries(star), today=dt.date(2024, 6, 1))
    assert f.countries == ("NATION_0", "NATION_1", "NATION_10", "NATION_11", "NATION_12")
    assert f.start == dt.date(2024, 1, 1) and f.categories == ()


def test_star_from_csv_end_to_end(spark, tmp_out):
    """A user's four CSV files -> clean -> load -> views -> KPIs and export."""
    from starkpi.plans import kpis
    files = {
        "dim_product": "product_id,product_name,category,sub_category,unit_cost\n"
                       "1,Desk Lamp,Furniture,Lighting,12.50\n2,Gel Pens,Office Supplies,Pens,2.00\n"
                       "2,Ball Pens,Office Supplies,Pens,2.00\n",
        "dim_customer": "customer_id,customer_name,segment,country,region\n"
                        "1,Omar Müller,Corporate,Germany,Europe\n2,Ivy Ito,Consumer,Japan,Asia Pacific\n",
        "dim_date": "date_id,day,month,month_name,quarter,year,is_weekend\n"
                    "2024-01-05,5,1,January,1,2024,0\n2024-01-06,6,1,January,1,2024,1\n",
        "fact_sales": "line_id,order_id,order_date,ship_date,customer_id,product_id,quantity,unit_price,"
                      "discount,sales_amount,profit\n"
                      "1,ORD-000010,2024-01-05,2024-01-07,1,1,2,20.00,0.10,0,11.00\n"
                      "1,ORD-000010,2024-01-05,2024-01-07,1,1,2,20.00,0.10,0,11.00\n"
                      "2,ORD-000011,2024-01-06,,2,2,0,3.00,0,0,0\n"
                      "3,ORD-000011,2024-01-06,2024-01-08,2,2,5,3.00,0.00,0,5.00\n",
    }
    paths = {}
    for name, text in files.items():
        paths[name] = f"{tmp_out}/{name}.csv"
        with open(paths[name], "w", encoding="utf-8") as f:
            f.write(text)
    star = Star.from_csv(spark, paths)
    rep = etl.run_pipeline(spark, star, tmp_out + "/star")  # lines are told apart by line_id
    assert rep["cast_failures"] == [] and rep["tables"]["fact_sales"]["rows"] == 2 and rep["tables"]["dim_product"]["rows"] == 2
    loaded = Star.from_layout(spark, tmp_out + "/star")
    k = kpis.kpi_summary(loaded).first()
    assert k["total_revenue"] == 36.0 + 15.0 and k["total_orders"] == 2
    assert {r["frequency"] for r in kpis.customer_rfm(loaded).collect()} == {1}
    assert {r["order_id"] for r in loaded.fact.collect()} == {"ORD-000010", "ORD-000011"}
    names = {r["customer_name"] for r in kpis.customer_rfm(loaded).collect()}
    assert "Omar Müller" in names
    # the first copy in file order survives ("Gel Pens", not the smaller "Ball Pens")
    assert {r["product_name"] for r in loaded.product.collect()} == {"Desk Lamp", "Gel Pens"}
    io.export_dashboard(spark, loaded, tmp_out + "/doc")
    text = "".join(open(os.path.join(tmp_out, "doc", f), encoding="utf-8").read()
                   for f in os.listdir(tmp_out + "/doc") if f.startswith("part-"))
    doc = json.loads(text)
    assert doc["kpi"][0]["total_orders"] == 2 and doc["benchmark"] is None
    io.export_dashboard(spark, loaded, tmp_out + "/doc2", bench_log=tmp_out + "/no_such_log.txt")
    text = "".join(open(os.path.join(tmp_out, "doc2", f), encoding="utf-8").read()
                   for f in os.listdir(tmp_out + "/doc2") if f.startswith("part-"))
    assert json.loads(text)["benchmark"] is None
    assert io.parse_benchmark_log(spark, tmp_out + "/no_such_log.txt").collect() == []


def test_views_answer_sql_like_the_functions(spark, star):
    from starkpi.plans import kpis
    io.register_views(spark, star)
    df, secs = io.run_query(spark, "SELECT * FROM vw_product_performance "
                                   "ORDER BY total_revenue DESC, product_name, category, sub_category LIMIT 10")
    assert secs >= 0 and [tuple(r) for r in df.collect()] == [tuple(r) for r in kpis.top_products(star, 10).collect()]
    rows, _ = io.run_query(spark, "SELECT COUNT(*) AS n FROM vw_customer_rfm WHERE frequency >= :f", args={"f": 1})
    assert rows.first()["n"] == kpis.customer_rfm(star).count()


def test_kpi_report_shapes(star):
    from starkpi.plans import kpis
    rep = kpis.kpi_report(star)
    assert list(rep) == ["summary", "last_months", "top_products", "categories", "regions", "top_customers"]
    assert rep["summary"].count() == 1 and rep["last_months"].count() == 6
    assert rep["top_products"].count() == 10 and rep["top_customers"].count() == 10
    months = [(r["year"], r["month"]) for r in rep["last_months"].collect()]
    assert months == sorted(months)


def test_layout_benchmark_log_round_trip(spark, star, tmp_out):
    from starkpi.plans import benchmark
    res = benchmark.run_benchmark(spark, star, tmp_out + "/b", "1996-06-01", "1996-06-30",
                                  log_path=tmp_out + "/log", runs=2)
    parsed = io.parse_benchmark_log(spark, tmp_out + "/log").first()
    assert parsed["without_avg_ms"] == round(res["plain"]["avg"] * 1000, 1)
    assert parsed["with_avg_ms"] == round(res["by_month"]["avg"] * 1000, 1)
    assert parsed["speedup_pct"] == round(res["gain_pct"], 1)


def test_star_as_catalog_tables(spark, star):
    from starkpi.catalog import DASH_FILTER
    from starkpi.plans import dashboard, kpis
    cleaned = etl.clean_star(star, etl.TESTDATA_LINE_KEY)
    rep = etl.load_star_tables(cleaned, prefix="t_")
    status = {r["table_name"]: r["row_count"] for r in io.catalog_status(
        spark, ["t_dim_product", "t_dim_customer", "t_dim_date", "t_fact_sales"]).collect()}
    assert status["t_fact_sales"] == rep["fact_sales"] == star.fact.count()
    loaded = Star.from_catalog(spark, "t_")
    assert kpis.kpi_summary(loaded).first() == kpis.kpi_summary(cleaned).first()
    assert dashboard.dash_kpis(loaded, DASH_FILTER).first() == dashboard.dash_kpis(cleaned, DASH_FILTER).first()


def test_customer_buckets_need_no_shuffle(spark, star):
    from starkpi.plans import kpis
    spark.sql("DROP TABLE IF EXISTS b_fact_sales")
    etl.load_star_tables(star, prefix="b_", layout="plain", customer_buckets=4)
    loaded, old = Star.from_catalog(spark, "b_"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rfm = kpis.customer_rfm(loaded)
        plan = rfm._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "hashpartitioning" not in plan, plan
        got = sorted(map(str, rfm.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == sorted(map(str, kpis.customer_rfm(star).collect()))
    with pytest.raises(ValueError, match="buckets"):
        etl.load_star_tables(star, prefix="b_", customer_buckets=4)


def test_create_empty_star_has_full_schemas(spark, tmp_out):
    io.create_empty_star(spark, tmp_out + "/empty")
    for name, struct in S.TABLES.items():
        df = spark.read.parquet(f"{tmp_out}/empty/{name}")
        assert df.count() == 0 and df.columns == struct.names


def test_pipeline_enforces_constraints(spark, tmp_out):
    import pytest
    good = {
        "dim_product": "product_id,product_name,category,sub_category,unit_cost\n1,Lamp,Furniture,Lighting,12.50\n",
        "dim_customer": "customer_id,customer_name,segment,country,region\n1,Ivy Ito,Consumer,Japan,Asia Pacific\n",
        "dim_date": "date_id,day,month,month_name,quarter,year,is_weekend\n2024-01-05,5,1,January,1,2024,0\n",
        "fact_sales": "line_id,order_id,order_date,customer_id,product_id,quantity,unit_price,discount,profit\n"
                      "1,10,2024-01-05,1,1,2,20.00,0.10,11.00\n",
    }

    def write(files, sub):
        paths = {}
        for name, text in files.items():
            paths[name] = f"{tmp_out}/{sub}_{name}.csv"
            with open(paths[name], "w", encoding="utf-8") as f:
                f.write(text)
        return Star.from_csv(spark, paths)

    rep = etl.run_pipeline(spark, write(good, "ok"), tmp_out + "/ok", line_key=["line_id"], enforce=True)
    assert rep["tables"]["fact_sales"]["rows"] == 1
    bad_fk = dict(good, fact_sales=good["fact_sales"] + "2,11,2024-01-05,1,99,1,5.00,0,1.00\n")
    with pytest.raises(ValueError, match="dim_product"):
        etl.run_pipeline(spark, write(bad_fk, "fk"), tmp_out + "/fk", line_key=["line_id"], enforce=True)
    null_discount = dict(good, fact_sales=good["fact_sales"] + "3,12,2024-01-05,1,1,1,5.00,,1.00\n")
    with pytest.raises(ValueError, match="sales_amount"):
        etl.run_pipeline(spark, write(null_discount, "nn"), tmp_out + "/nn", line_key=["line_id"], enforce=True)
    assert not os.path.exists(tmp_out + "/nn/fact_sales")  # nothing written on a breach


FACT_HEADER = "line_id,order_id,order_date,customer_id,product_id,quantity,unit_price,discount,profit\n"


def test_three_lines_that_differ_only_by_line_id_all_load(spark, tmp_out):
    same = "ORD-000001,2024-01-05,1,1,2,20.00,0.10,11.00\n"
    files = {
        "dim_product": "product_id,product_name,category,sub_category,unit_cost\n1,Lamp,Furniture,Lighting,12.50\n",
        "dim_customer": "customer_id,customer_name,segment,country,region\n1,Ivy Ito,Consumer,Japan,Asia Pacific\n",
        "dim_date": "date_id,day,month,month_name,quarter,year,is_weekend\n2024-01-05,5,1,January,1,2024,0\n",
        "fact_sales": FACT_HEADER + "".join(f"{i},{same}" for i in (1, 2, 3)) + "4,ORD-000002,2024-01-05,1,1,many,x,0,1.00\n",
    }
    paths = {}
    for name, text in files.items():
        paths[name] = f"{tmp_out}/{name}.csv"
        with open(paths[name], "w", encoding="utf-8") as f:
            f.write(text)
    star = Star.from_csv(spark, paths)
    report = {(r["table_name"], r["column_name"], r["failed"], r["example"]) for r in star.cast_failures.collect()}
    # the load counts them itself: the report's own scan, made to fail here, is not run
    poison = spark.range(1).select(F.raise_error(F.lit("a second scan")).alias("x"))
    star = replace(star, cast_failures=poison)
    rep = etl.run_pipeline(spark, star, tmp_out + "/star")
    assert rep["tables"]["fact_sales"]["rows"] == 3
    assert {tuple(r.values()) for r in rep["cast_failures"]} == report
    assert {(r["column_name"], r["failed"], r["example"]) for r in rep["cast_failures"]} == {
        ("quantity", 1, "many"), ("unit_price", 1, "x")}
    import pytest
    with pytest.raises(ValueError, match="cannot be read"):
        etl.run_pipeline(spark, star, tmp_out + "/star2", enforce=True)
    assert snapshots.current(spark, tmp_out + "/star2") is None  # nothing published
    bare = Star(fact=star.fact.drop("line_id"), product=star.product, customer=star.customer, date=star.date)
    with pytest.raises(ValueError, match="line_key"):
        etl.run_pipeline(spark, bare, tmp_out + "/star3")


def test_csv_files_of_another_column_order_fail(spark, tmp_out):
    import pytest
    os.makedirs(tmp_out + "/many")
    for name, text in (("a", "customer_id,customer_name\n1,Ann\n"), ("b", "customer_name,customer_id\nBob,2\n")):
        with open(f"{tmp_out}/many/{name}.csv", "w", encoding="utf-8") as f:
            f.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        io.read_csv(spark, tmp_out + "/many", S.DIM_CUSTOMER).collect()


def test_document_refuses_unbounded_datasets(spark, tmp_out):
    import pytest
    with pytest.raises(Exception, match="more than 5 rows"):
        io.export_document(spark, {"d": spark.range(9).toDF("x")}, tmp_out + "/doc", max_rows=5)


def test_views_follow_appends(spark, star, tmp_out):
    root = tmp_out + "/star"
    etl.run_pipeline(spark, star, root)
    read = lambda view: spark.sql(f"SELECT SUM(total_revenue) AS s FROM {view}").first()["s"]
    views = ("vw_kpi_summary", "vw_product_performance")
    before = [read(v) for v in views]
    sale = spark.createDataFrame(
        [("ORD1", dt.date(1996, 6, 15), 1, 1, 1, D("1000000.00"), D("0.00"), D("1000000.00"), D("12.00"))],
        "order_id string, order_date date, customer_id long, product_id long, quantity int, "
        "unit_price decimal(18,2), discount decimal(4,2), sales_amount decimal(18,2), profit decimal(18,2)")
    io.append_sales(sale, snapshots.resolve(spark, root) + "/fact_sales", partition_by=["order_month"])
    for v in views:
        spark.catalog.refreshTable(v)
    assert [round(read(v) - b) for v, b in zip(views, before)] == [1_000_000, 1_000_000]


def test_views_come_sorted_and_build_without_jobs(spark, star):
    from starkpi.plans import kpis, trends
    for build, value in ((kpis.product_performance, "total_revenue"), (kpis.category_performance, "total_revenue"),
                         (kpis.regional_performance, "total_revenue"), (kpis.customer_rfm, "monetary_value")):
        got = [r[value] for r in build(star).collect()]
        assert got == sorted(got, reverse=True) and len(got) > 1
    spark.sparkContext.setJobGroup("build", "plans only")
    try:
        for build in (kpis.product_performance, kpis.top_products, trends.product_pareto, kpis.top_margin_products):
            build(star)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
