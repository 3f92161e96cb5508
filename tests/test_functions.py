"""Scalar functions: calendar, pricing, identifiers and display formats."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from starkpi.functions import formatting as fmt
from starkpi.functions import pricing
from starkpi.functions.calendar import calendar, month_label
from starkpi.functions.numeric import gain_pct, pct, ratio


def test_calendar_matches_python(spark):
    rows = calendar(spark, 2022, 3).orderBy("date_id").collect()
    assert len(rows) == 1096  # 2022-2024, one leap year
    for r in rows[::37]:
        d = r["date_id"]
        assert (r["day"], r["month"], r["quarter"], r["year"]) == (d.day, d.month, (d.month - 1) // 3 + 1, d.year)
        assert r["month_name"] == d.strftime("%B")
        assert r["is_weekend"] == (1 if d.weekday() >= 5 else 0)
    assert rows[0]["date_id"] == dt.date(2022, 1, 1) and rows[-1]["date_id"] == dt.date(2024, 12, 31)


def test_ship_date_and_lag(spark):
    df = spark.createDataFrame([("2024-02-27", 3), ("junk", 2), (None, 1)], "d string, n int")
    got = [r[0] for r in df.select(pricing.ship_date("d", "n")).collect()]
    assert got == ["2024-03-01", "junk", None]  # an order date that is none stays as it is
    lag = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 8))], "o date, s date")
    assert lag.select(pricing.ship_lag_days("o", "s")).first()[0] == 7


def test_labels(spark):
    df = spark.createDataFrame([(123, 2024, 3, dt.datetime(2024, 5, 1, 0, 0, 5))], "n long, y int, m int, ts timestamp")
    r = df.select(pricing.order_label("n").alias("a"), month_label("y", "m").alias("b"),
                  pricing.manual_order_id("ts").alias("c"), fmt.day_stamp("ts").alias("d")).first()
    assert r["a"] == "ORD-000123" and r["b"] == "2024-03" and r["d"] == "20240501"
    assert r["c"] == "ORD" + str(int(dt.datetime(2024, 5, 1, 0, 0, 5, tzinfo=dt.timezone.utc).timestamp()))


def test_sales_and_profit_are_exact(spark):
    df = spark.createDataFrame([(3, D("19.99"), D("0.15"), D("7.25"))],
                               "q int, p decimal(18,2), d decimal(4,2), c decimal(10,2)")
    r = df.select(pricing.sales_amount("q", "p", "d").alias("s")).select(
        "s", pricing.line_profit("s", F.lit(3), F.lit(D("7.25"))).alias("pr")).first()
    assert r["s"] == D("50.97") and r["pr"] == D("29.22")  # 50.9745 rounds half-up


def test_display_formats(spark):
    df = spark.createDataFrame([(1234.5, -98.0, 41.66, 2.5)], "a double, b double, m double, h double")
    r = df.select(fmt.currency("a", 2).alias("a2"), fmt.currency("a", 0).alias("a0"),
                  fmt.currency("b", 0).alias("b0"), fmt.percent("m", 1).alias("m1"),
                  fmt.number("h", 0).alias("h0")).first()
    assert (r["a2"], r["a0"], r["b0"], r["m1"], r["h0"]) == ("$1,234.50", "$1,234", "$-98", "41.7%", "2")


def test_ratio_rules(spark):
    df = spark.createDataFrame([(326065.47, 6.0, 0.0)], "a double, b double, z double")
    r = df.select(ratio("a", "b").alias("r"), ratio("a", "z").alias("rz"), pct("b", "a", 4).alias("p"),
                  gain_pct(F.lit(56.5), F.lit(74.4)).alias("g")).first()
    assert r["r"] == 54344.25 and r["rz"] is None and r["g"] == -31.7


def test_recommended_conf_scales_with_shuffled_bytes():
    from starkpi.session import recommended_conf
    wide = recommended_conf(4 * 2**40, 8000)           # 4 TB shuffled on 8,000 cores: three waves
    assert int(wide["spark.sql.shuffle.partitions"]) == 24_000
    assert int(recommended_conf(100 * 2**40, 8000)["spark.sql.shuffle.partitions"]) == 32_768
    assert int(recommended_conf(10 * 2**20, 8)["spark.sql.shuffle.partitions"]) == 8


def test_percent_has_no_thousands_separator(spark):
    df = spark.createDataFrame([(1234.56,), (0.25,)], "m double")
    assert [r[0] for r in df.select(fmt.percent("m", 1)).collect()] == ["1234.6%", "0.2%"]  # half-even on 0.25
