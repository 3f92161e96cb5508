"""Layout benchmark and streaming ingest."""

import datetime as dt
import os
from decimal import Decimal as D

from pyspark.sql import functions as F

from starkpi.plans import benchmark, layout
from starkpi.plans.lines import LINE_FIRST, LINE_KEY
from starkpi.sources.star import FACT_COLUMNS
from starkpi.streaming import ingest


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_month_layout_gives_same_answer(spark, star, tmp_out):
    res = benchmark.layout_benchmark(spark, star, tmp_out, "1996-06-01", "1996-06-30", runs=1)
    assert "PartitionFilters" in res["plan"]
    plain = benchmark.month_query(star.with_fact(spark.read.parquet(tmp_out + "/fact_plain")),
                                  "1996-06-01", "1996-06-30", False)
    part = benchmark.month_query(star.with_fact(spark.read.parquet(tmp_out + "/fact_by_month")),
                                 "1996-06-01", "1996-06-30", True)
    assert _rows(plain) == _rows(part) and len(_rows(plain)) > 0


def test_by_month_layout_prunes(spark, star, tmp_out):
    layout.write_fact(star.fact, tmp_out + "/f", "by_month")
    months = [d for d in os.listdir(tmp_out + "/f") if d.startswith("order_month=")]
    assert len(months) > 12
    q = benchmark.month_query(star.with_fact(spark.read.parquet(tmp_out + "/f")),
                              "1996-06-01", "1996-06-30", True)
    assert "order_month" in benchmark.explain_text(q)


def test_stream_two_batches_with_repeat_equals_batch(spark, star, tmp_out):
    fact = star.fact.select(*FACT_COLUMNS)
    src = tmp_out + "/incoming"
    a = fact.filter("order_id % 2 = 0")
    b = fact.filter("order_id % 2 = 1")
    repeat = fact.limit(5)
    a.coalesce(1).write.parquet(src + "/batch1")
    target, kpi = tmp_out + "/target", tmp_out + "/kpi"
    kw = dict(key=LINE_KEY, order_cols=LINE_FIRST, product=star.product, kpi_path=kpi,
              checkpoint=tmp_out + "/ckpt")
    ingest.run_available(spark, src + "/*", fact.schema, target, **kw)
    b.union(repeat).coalesce(1).write.parquet(src + "/batch2")
    ingest.run_available(spark, src + "/*", fact.schema, target, **kw)
    got = spark.read.parquet(target).select(*FACT_COLUMNS)
    from starkpi.plans.lines import clean_lines
    from starkpi.plans.lines import money_to_double
    expect = clean_lines(star)
    assert _rows(money_to_double(got)) == _rows(expect.select(*FACT_COLUMNS))
    # live daily KPIs equal a batch recompute over the target
    from pyspark.sql import functions as F
    k = spark.read.parquet(kpi).agg(F.sum("revenue")).first()[0]
    assert k == got.agg(F.sum("sales_amount")).first()[0]
    # live KPI row equals the batch KPI row of the cleaned lines
    from starkpi.plans import kpis
    from starkpi.sources.star import Star
    live = ingest.live_summary(spark, target, star.product, star.customer, star.date).first()
    batch = kpis.kpi_summary(Star(fact=clean_lines(star), product=star.product, customer=star.customer,
                                  date=star.date)).first()
    assert live == batch


def test_loaded_star_prunes_months_in_dashboard_queries(spark, star, tmp_out):
    from starkpi.catalog import DASH_FILTER
    from starkpi.plans import dashboard, etl
    from starkpi.sources.star import Star
    etl.load_star(etl.clean_star(star, etl.TESTDATA_LINE_KEY), tmp_out + "/star")
    loaded = Star.from_layout(spark, tmp_out + "/star")
    q = dashboard.dash_kpis(loaded, DASH_FILTER)
    plan = benchmark.explain_text(q)
    assert "PartitionFilters: [isnotnull(order_month" in plan
    lazy = dashboard.dash_kpis(etl.clean_star(star, etl.TESTDATA_LINE_KEY), DASH_FILTER).first()
    assert q.first() == lazy


def test_calendar_attributes_prune_months(spark, star, tmp_out):
    from starkpi.plans import etl, trends
    from starkpi.sources.star import Star
    etl.load_star(etl.clean_star(star, etl.TESTDATA_LINE_KEY), tmp_out + "/star")
    loaded = Star.from_layout(spark, tmp_out + "/star")
    months = loaded.fact.select("order_month").distinct().count()
    expected = _rows(trends.weekend_revenue(etl.clean_star(star, etl.TESTDATA_LINE_KEY)))
    assert len(expected) > 3 and {r[1] for r in expected} == {10, 11, 12}
    q = trends.weekend_revenue(loaded)
    assert _rows(q) == expected
    plan = benchmark.explain_text(q)
    assert "dynamicpruning" in plan.lower()
    # the partitions that the fact's scan read, from its own metrics
    q.collect()
    found, todo = [], [q._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "FileSourceScanExec" and node.metrics().contains("numPartitions"):
            found.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    assert len(found) == 1 and 0 < found[0] <= months / 3
    # attributes that no partition column knows, and an unpartitioned fact
    plain = Star(fact=loaded.fact.drop("order_month"), product=loaded.product, customer=loaded.customer, date=loaded.date)
    assert _rows(trends.weekend_revenue(plain)) == expected
    assert trends.calendar_revenue(loaded, F.col("year") == 1800).collect() == []


def test_stream_csv_files(spark, star, tmp_out):
    from pyspark.sql import functions as F
    from starkpi.schema import FACT_SALES
    cols = [f.name for f in FACT_SALES.fields]
    src = tmp_out + "/csv_in"
    os.makedirs(src)
    header = ",".join(cols)
    rows = ["1,10,1,2024-01-05,2024-01-07,1,1,0,2,20.00,0.10,0,11.00",
            "1,10,1,2024-01-05,2024-01-07,1,1,0,2,20.00,0.10,0,11.00",   # repeated line
            "2,10,2,junk,,1,1,0,2,20.00,0.10,0,11.00",                   # bad date -> dropped
            "3,11,1,2024-02-06,,2,2,0,5,3.00,0.00,0,5.00"]
    with open(src + "/a.csv", "w", encoding="utf-8") as f:
        f.write(header + "\n" + "\n".join(rows) + "\n")
    target = tmp_out + "/csv_target"
    ingest.run_available(spark, src, FACT_SALES, target, key=["line_id"],
                         order_cols=[c for c in cols if c != "line_id"], fmt="csv",
                         checkpoint=tmp_out + "/csv_ckpt")
    got = spark.read.parquet(target)
    assert sorted(r["line_id"] for r in got.collect()) == [1, 3]
    assert got.agg(F.sum("sales_amount")).first()[0] == D("51.00")  # 36.00 + 15.00 recomputed


def test_hot_month_is_written_by_several_tasks(spark, star, tmp_out):
    import datetime as dt
    from pyspark.sql import functions as F
    fact = star.fact.withColumn("order_date", F.when(F.col("order_id") % 3 == 0, F.lit(dt.date(1997, 5, 15)))
                                .otherwise(F.col("order_date"))).repartition(8)  # several map tasks, as on a cluster
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4096")
        layout.write_fact(fact, tmp_out + "/hot", "by_month")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f for f in os.listdir(tmp_out + "/hot/order_month=1997-05-01") if f.endswith(".parquet")]
    assert len(files) > 1  # the hot month was split over several write tasks
    assert spark.read.parquet(tmp_out + "/hot").count() == fact.count()


def _line(line_id, date, amount="40.00"):
    return (line_id, "ORD1", 1, dt.date.fromisoformat(date), None, 1, 1, 0, 2, D("20.00"), D("0.00"), D(amount), D("1.00"))


def test_append_tells_lines_apart_by_key_alone(spark, tmp_out):
    from starkpi.schema import FACT_SALES_INPUT
    target = tmp_out + "/target"

    def append(*rows):
        batch = spark.createDataFrame(list(rows), FACT_SALES_INPUT)
        ingest.append_new_lines(batch, target, ["line_id"], ["order_date"])
        return sorted((r["line_id"] is not None, r["line_id"]) for r in spark.read.parquet(target).collect())

    first = [(False, None), (True, 1)]
    assert append(_line(1, "2024-01-05"), _line(None, "2024-01-06")) == first
    assert append(_line(1, "2024-02-05"), _line(None, "2024-01-07")) == first  # another month, a NULL key
    assert append(_line(1, "2024-01-05"), _line(None, "2024-01-06")) == first  # a replayed batch
    assert append(_line(2, "2024-02-05")) == [*first, (True, 2)]


def test_unreadable_target_raises(spark, tmp_out):
    import pytest
    from starkpi.schema import FACT_SALES_INPUT
    os.makedirs(tmp_out + "/broken/order_month=2024-01-01")
    with open(tmp_out + "/broken/order_month=2024-01-01/part-0.parquet", "w") as f:
        f.write("no parquet")
    batch = spark.createDataFrame([_line(1, "2024-01-05")], FACT_SALES_INPUT)
    with pytest.raises(Exception):
        ingest.append_new_lines(batch, tmp_out + "/broken", ["line_id"], ["order_date"])


def _bytes_read(df):
    """Bytes of the files that a plan of one scan read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("filesSize").value() for i in range(leaves.size()))


def test_key_index_reads_its_buckets_only(spark, tmp_out):
    from starkpi.streaming.key_index import KeyIndex
    table = tmp_out + "/table"

    def rows(low, high):
        return spark.range(low, high).select(F.concat(F.lit("ORD-"), "id").alias("order_id"), (F.col("id") % 5).cast("int").alias("n"),
                                             F.lit("x" * 20).alias("payload"))

    index = KeyIndex(spark, table, tmp_out + "/keys", ["order_id", "n"], keys_per_bucket=2000)
    batch = rows(997, 1003)
    assert index.catch_up() == 0 and index.unseen(batch).count() == 6
    rows(0, 20_000).coalesce(2).write.mode("append").parquet(table)
    assert index.catch_up() == 2 and index.catch_up() == 0
    assert index.unseen(batch).count() == 0
    small = _bytes_read(index.candidates(batch))
    for low in range(20_000, 200_000, 60_000):  # ten times the keys
        rows(low, low + 60_000).coalesce(2).write.mode("append").parquet(table)
        index.catch_up()
    assert index.unseen(batch.unionByName(rows(199_990, 200_010))).count() == 10
    whole = _bytes_read(spark.read.parquet(index._state()[0] + "/keys"))
    large = _bytes_read(index.candidates(batch))
    assert large < 1.5 * small and large < whole / 4, (small, large, whole)
    assert index.unseen(rows(0, 200_005)).count() == 5  # more keys than are pushed down


def test_key_index_survives_a_run_that_dies(spark, tmp_out, monkeypatch):
    """Lines appended, but not their keys; keys added, but not noted: no line twice, none lost."""
    from starkpi.schema import FACT_SALES_INPUT
    from starkpi.streaming.key_index import KeyIndex
    target = tmp_out + "/target"

    def append(*ids):
        batch = spark.createDataFrame([_line(i, "2024-01-05") for i in ids], FACT_SALES_INPUT)
        ingest.append_new_lines(batch, target, ["line_id"], ["order_date"])
        return sorted(r["line_id"] for r in spark.read.parquet(target).collect())

    def dies(*args):
        raise RuntimeError("killed")

    assert append(1, 2) == [1, 2]  # its keys are added by the next batch
    with monkeypatch.context() as m:
        m.setattr(KeyIndex, "_note", dies)
        try:
            append(2, 3)
            raise AssertionError("must die")
        except RuntimeError:
            pass
    assert append(2, 3) == [1, 2, 3]
    assert append(1, 2, 3) == [1, 2, 3]


def test_live_kpis_follow_batches_without_the_target(spark, star, tmp_out):
    from starkpi.plans.kpis import kpi_summary
    from starkpi.plans.layout import with_order_month
    from starkpi.streaming import live
    target, path, ckpt = tmp_out + "/target", tmp_out + "/live", tmp_out + "/live_ckpt"
    # orders span batches, days and categories; one product is unknown
    product = star.product.where("product_id <> 1")
    # lines of each batch: an order's lines lie in different ones
    parts = [star.fact.filter(f"product_id % 3 = {i}") for i in range(3)]
    taken = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        for n, part in enumerate(parts, 1):
            ingest_rows = with_order_month(part)
            ingest_rows.coalesce(1).write.mode("append").partitionBy("order_month").parquet(target)
            # every run is a restart from the checkpoint
            query = live.start(spark, live.appended_lines(spark, target, max_files_per_trigger=50), product, path, ckpt, compact_every=2)
            query.awaitTermination()
            taken.append(sum(p["numInputRows"] for p in query.recentProgress))
            held = spark.read.parquet(target)
            want = live.running_kpis(held, product)
            for grain in ("day", "category", "total"):
                got = live.kpis(spark, path, grain).withColumnRenamed(grain, "member")
                assert _rows(got) == _rows(want.where(F.col("grain") == grain).drop("grain")), (n, grain)
            assert live.summary(spark, path).first() == kpi_summary(star.with_fact(held)).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    lines = [p.count() for p in parts]
    assert taken == [2 * n for n in lines]  # each line once for the sums, once for the orders
    days = star.fact.groupBy("order_date").agg(F.count_distinct("order_id").alias("n")).collect()
    got = {r["day"]: r["orders"] for r in live.kpis(spark, path, "day").collect()}
    assert got == {str(r["order_date"]): r["n"] for r in days}


def test_live_kpis_of_nothing(spark, star, tmp_out):
    import pytest
    from starkpi.streaming import live
    with pytest.raises(ValueError):
        live.kpis(spark, tmp_out + "/nothing", "total")
    empty = live.running_kpis(star.fact.limit(0), star.product)
    assert empty.count() == 0
