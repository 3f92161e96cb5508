"""Monthly rollups: the views equal a recompute after appends that touch few months."""

from pyspark.sql import functions as F

from starkpi.operators import bitmaps
from starkpi.plans import etl, kpis, rollups
from starkpi.sources import io
from starkpi.sources.star import LINE_ORDER, Star


def _same(got, want):
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def _check(spark, root, kept, names=tuple(rollups.VIEWS)):
    star = Star.from_layout(spark, root)
    rolled = rollups.RolledStar.over(star, rollups.read_rollup(spark, kept))
    for name in names:
        _same(rollups.VIEWS[name](rolled), getattr(kpis, name)(star))


def test_views_follow_appends_reading_touched_months_only(spark, star, tmp_out):
    root, kept = tmp_out + "/star", tmp_out + "/rollup"
    star = star.with_fact(star.fact.where("order_date < '1996-01-01'"))
    etl.run_pipeline(spark, star, root, line_key=list(LINE_ORDER))
    loaded = Star.from_layout(spark, root)
    whole = loaded.fact.count()
    first = rollups.refresh(spark, loaded, kept)
    assert first["lines"] == whole and len(first["months"]) == loaded.fact.select("order_month").distinct().count()
    assert rollups.refresh(spark, loaded, kept) == {"months": [], "dropped": [], "lines": 0}
    # an order seen in one month, an order repeated in another month, a new one, one without
    # its product and one without its customer
    old = loaded.fact.where("order_date < '1995-03-01'").limit(5).drop("order_month")
    moved = old.withColumn("order_date", F.lit("1995-09-09").cast("date"))
    fresh = old.withColumn("order_id", F.lit("ORD-new")).withColumn("order_date", F.lit("1995-09-30").cast("date"))
    lost = moved.withColumn("product_id", F.lit(-1).cast("long")).unionByName(moved.withColumn("customer_id", F.lit(-1).cast("long")))
    folder = loaded.fact.inputFiles()[0].split("/fact_sales/")[0] + "/fact_sales"
    io.append_sales(moved.unionByName(fresh).unionByName(lost), folder, ["order_month"])
    now = Star.from_layout(spark, root)
    second = rollups.refresh(spark, now, kept)
    assert second["months"] == ["1995-09-01"] and second["dropped"] == []
    assert second["lines"] == now.fact.where("order_month = '1995-09-01'").count() < whole / 5
    _check(spark, root, kept)
    views = rollups.register_views(spark, now, kept)
    assert spark.table("vw_kpi_summary").count() == 1 and len(views) == 6
    # a refreshed star is another folder of files: everything is made anew, gone months go
    etl.run_pipeline(spark, star.with_fact(star.fact.where("order_date >= '1995-11-01'")), root, line_key=list(LINE_ORDER))
    third = rollups.refresh(spark, Star.from_layout(spark, root), kept)
    assert third["dropped"] and third["months"] == ["1995-11-01", "1995-12-01"]
    _check(spark, root, kept, ["kpi_summary", "category_performance"])


def test_a_refresh_that_dies_leaves_the_rollup_that_was_there(spark, star, tmp_out, monkeypatch):
    root, kept = tmp_out + "/star", tmp_out + "/rollup"
    etl.run_pipeline(spark, star.with_fact(star.fact.where("order_date < '1995-02-01'")), root, line_key=list(LINE_ORDER))
    rollups.refresh(spark, Star.from_layout(spark, root), kept)
    before = sorted(map(str, rollups.read_rollup(spark, kept).collect()))
    etl.run_pipeline(spark, star.with_fact(star.fact.where("order_date < '1995-03-01'")), root, line_key=list(LINE_ORDER))

    def dies(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(rollups, "bitmap_rows", dies)
        try:
            rollups.refresh(spark, Star.from_layout(spark, root), kept)
            raise AssertionError("went on")
        except RuntimeError:
            pass
    assert sorted(map(str, rollups.read_rollup(spark, kept).collect())) == before
    assert rollups.refresh(spark, Star.from_layout(spark, root), kept)["months"]
    _check(spark, root, kept, ["kpi_summary", "customer_rfm"])


def test_lines_without_a_date_and_empty_facts(spark, star, tmp_out):
    part = star.fact.where("order_date < '1995-02-01'")
    dateless = part.limit(7).withColumn("order_date", F.lit(None).cast("date")).withColumn("order_id", F.col("order_id") + 10_000_000)
    mixed = star.with_fact(part.unionByName(dateless).unionByName(part.limit(3).withColumn("order_id", F.lit(None).cast("long"))))
    etl.load_star(mixed, tmp_out + "/mixed")
    rollups.refresh(spark, Star.from_layout(spark, tmp_out + "/mixed"), tmp_out + "/r1")
    _check(spark, tmp_out + "/mixed", tmp_out + "/r1")
    none = rollups.rolled(star.with_fact(star.fact.where("false")))
    for name, view in rollups.VIEWS.items():
        _same(view(none), getattr(kpis, name)(none))
    empty = rollups.RolledStar.over(star, rollups.read_rollup(spark, tmp_out + "/never"))
    assert rollups.kpi_summary(empty).first()["total_orders"] == 0 and rollups.customer_rfm(empty).count() == 0


def test_bitmaps_of_days_outside_the_calendar(spark, star):
    short = Star(fact=star.fact, product=star.product, customer=star.customer,
                 date=star.date.where("date_id < '1996-05-17'"))
    _same(rollups.monthly_revenue(rollups.rolled(short)), kpis.monthly_revenue(short))
    total = bitmaps.distinct_counts(rollups.rolled(short).kind("order"), [], "n").first()["n"]
    assert total == star.fact.select("order_id").distinct().count()


def test_bitmaps_are_made_without_a_table_of_visits(spark, star):
    plan = rollups.kpi_summary(rollups.rolled(star))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [order_month" in plan and "category" not in plan  # no distinct visits, of which category is a column
