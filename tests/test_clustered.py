"""The clustered layout: one table that date, product and customer filters all skip through."""

import datetime as dt

from pyspark.sql import functions as F

from starkpi.plans import explorer, layout
from tests.test_bitmaps_lookups import _rows_read


def test_every_clustered_column_skips_files(spark, star, tmp_out):
    facts = star.fact.repartition(8).cache()
    whole = facts.count()
    path = tmp_out + "/clustered"
    layout.write_fact(facts, path, "clustered", files=512)
    loaded = star.with_fact(spark.read.parquet(path))
    plain = star.with_fact(facts)
    assert sorted(map(str, explorer.bench_month_product(loaded, "1996-06-01", "1996-06-30").collect())) == \
        sorted(map(str, explorer.bench_month_product(plain, "1996-06-01", "1996-06-30").collect()))
    day = dt.date(1996, 6, 15)
    for column, wanted in (("order_date", F.col("order_date").between(dt.date(1996, 6, 1), dt.date(1996, 6, 30))),
                           ("customer_id", F.col("customer_id").between(40, 42)), ("product_id", F.col("product_id") == 42),
                           ("two", (F.col("order_date") >= day) & (F.col("customer_id") < 20))):
        got = loaded.fact.where(wanted).select("order_date", "customer_id", "product_id", "quantity")
        rows = got.collect()
        want = facts.where(wanted).select(*got.columns).collect()
        assert sorted(map(str, rows)) == sorted(map(str, want)) and rows, column
        assert _rows_read(got) < whole / 2 if column == "two" else _rows_read(got) < whole / 3, (column, _rows_read(got), whole)
    facts.unpersist()


def test_clustered_nulls_hot_values_and_empty(spark, star, tmp_out):
    odd = star.fact.limit(300).withColumn("customer_id", F.when(F.col("line_number") > 1, F.lit(7).cast("long"))) \
        .withColumn("order_date", F.when(F.col("line_number") < 3, F.col("order_date")))
    for name, df in (("odd", odd.cache()), ("none", odd.where("false"))):
        layout.write_fact(df, f"{tmp_out}/{name}", "clustered", files=4)
        back = spark.read.parquet(f"{tmp_out}/{name}")
        assert back.columns == df.columns
        cols = ["customer_id", "order_date", "product_id", "quantity"]
        assert sorted(map(str, back.select(*cols).collect())) == sorted(map(str, df.select(*cols).collect()))
    odd.unpersist()
