"""Bitmaps that roll up, and lookups by id that skip row groups."""

from pyspark.sql import functions as F

from starkpi.operators import bitmaps
from starkpi.plans import explorer, layout
from starkpi.sources.star import Star


def test_monthly_bitmaps_give_yearly_and_total_orders(spark, star):
    facts = star.fact.withColumn("order_month", F.trunc("order_date", "month")).withColumn("year", F.year("order_date"))
    monthly = bitmaps.id_bitmaps(facts, "order_id", ["order_month", "year"])
    for groups in (["order_month"], ["year"], []):
        want = facts.groupBy(*groups).agg(F.count_distinct("order_id").alias("n"))
        assert sorted(map(tuple, bitmaps.distinct_counts(monthly, groups, "n").collect())) == sorted(map(tuple, want.collect()))


def test_text_ids_are_numbered_in_generations(spark, tmp_out):
    def lines(low, high):
        return spark.range(low, high).select(F.concat(F.lit("ORD-"), F.col("id") % 500).alias("order_id"), (F.col("id") % 3).alias("g"))

    first, both = lines(0, 900), lines(0, 900).unionByName(lines(400, 2000))
    bitmaps.number_ids(first.where("order_id < 'ORD-3'"), "order_id").write.parquet(tmp_out + "/numbers/g=0")
    known = spark.read.parquet(tmp_out + "/numbers")
    bitmaps.number_ids(both, "order_id", known, generation=1).write.parquet(tmp_out + "/numbers/g=1")
    numbers = spark.read.parquet(tmp_out + "/numbers").drop("g")
    assert numbers.count() == numbers.select("number").distinct().count() == numbers.select("order_id").distinct().count() == 500
    made = bitmaps.id_bitmaps(both.join(numbers, "order_id"), "number", ["g"])
    want = both.groupBy("g").agg(F.count_distinct("order_id").alias("n"))
    assert sorted(map(tuple, bitmaps.distinct_counts(made, ["g"], "n").collect())) == sorted(map(tuple, want.collect()))
    assert bitmaps.distinct_counts(made, [], "n").first()["n"] == 500
    nothing = bitmaps.id_bitmaps(both.select("g", F.lit(None).cast("long").alias("n")), "n", ["g"])
    assert nothing.count() == 0


def _rows_read(df):
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookup_by_order_skips_row_groups(spark, star, tmp_out):
    # ids that no dictionary holds: spread over the whole range, many row groups in one month
    wide = star.fact.withColumn("order_id", F.xxhash64("order_id")).withColumn("order_date", F.lit("1996-06-01").cast("date"))
    wide = wide.unionByName(wide.withColumn("order_id", F.col("order_id") + 1)).repartition(3).cache()
    layout.fact_writer(wide, "by_month").option("parquet.block.size", "16384").option("parquet.block.size.row.check.min", "100") \
        .option("parquet.page.row.count.limit", "500").option("parquet.enable.dictionary", "false").parquet(tmp_out + "/star/fact_sales")
    for name, df in (("dim_product", star.product), ("dim_customer", star.customer), ("dim_date", star.date)):
        df.write.parquet(f"{tmp_out}/star/{name}")
    loaded = Star.from_layout(spark, tmp_out + "/star")
    wanted = wide.select("order_id").first()[0]
    got = explorer.order_lines(loaded, wanted)
    rows = got.collect()
    want = explorer.order_lines(star.with_fact(wide), wanted).drop("line_number").withColumn("order_id", F.col("order_id").cast("string"))
    assert sorted(map(str, got.drop("line_number").collect())) == sorted(map(str, want.collect())) and rows
    read, whole = _rows_read(got), wide.count()
    wide.unpersist()
    assert len(rows) <= read < whole / 3, (read, whole)
    missing = explorer.order_lines(loaded, 1)
    assert missing.collect() == [] and _rows_read(missing) < whole / 3
    one = star.customer.first()["customer_id"]
    assert explorer.customer_lines(loaded, one).count() == wide.filter(F.col("customer_id") == one).count()
