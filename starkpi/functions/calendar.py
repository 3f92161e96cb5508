"""Calendar dimension (F7, F8) and month labels.

The calendar is generated inside Spark with ``sequence`` + ``explode``: one
row per day, so its size is bounded by the date span (366 rows per year),
which is what makes it safe to broadcast into fact joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar_fields(date_col: str = "date_id") -> list[Column]:
    """Calendar attributes of a date: day, month, month name, quarter, year,
    weekend flag (Saturday/Sunday = 1, else 0)."""
    d = F.col(date_col)
    return [
        d.alias("date_id"),
        F.dayofmonth(d).cast("int").alias("day"),
        F.month(d).cast("int").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).cast("int").alias("quarter"),
        F.year(d).cast("int").alias("year"),
        F.dayofweek(d).isin(1, 7).cast("int").alias("is_weekend"),
    ]


def _days(bounds: DataFrame, lo: str, hi_exclusive: str) -> DataFrame:
    return bounds.select(
        F.explode(F.sequence(F.col(lo), F.date_sub(F.col(hi_exclusive), 1),
                             F.expr("INTERVAL 1 DAY"))).alias("date_id"))


def calendar(spark: SparkSession, start_year: int, years: int) -> DataFrame:
    """One row per day from Jan 1 of ``start_year`` to Jan 1 of
    ``start_year + years`` (exclusive)."""
    bounds = spark.range(1).select(
        F.make_date(F.lit(start_year), F.lit(1), F.lit(1)).alias("lo"),
        F.make_date(F.lit(start_year + years), F.lit(1), F.lit(1)).alias("hi"))
    return _days(bounds, "lo", "hi").select(*calendar_fields())


def calendar_covering(df: DataFrame, date_col: str) -> DataFrame:
    """Calendar of whole years spanning the dates found in ``df[date_col]``.

    Bounds come from one global min/max aggregate (partial aggregation on
    every partition), so nothing but two dates reaches a single task.
    """
    bounds = df.agg(F.min(F.col(date_col).cast("date")).alias("lo_d"),
                    F.max(F.col(date_col).cast("date")).alias("hi_d")).select(
        F.make_date(F.year("lo_d"), F.lit(1), F.lit(1)).alias("lo"),
        F.make_date(F.year("hi_d") + 1, F.lit(1), F.lit(1)).alias("hi"))
    return _days(bounds, "lo", "hi").select(*calendar_fields())


def month_label(year_col="year", month_col="month") -> Column:
    """``YYYY-MM`` label of a (year, month) pair."""
    return F.format_string("%04d-%02d", F.col(year_col), F.col(month_col))


def month_index(year_col="year", month_col="month") -> Column:
    """Months since year 0, so consecutive months differ by exactly 1."""
    return (F.col(year_col) * 12 + F.col(month_col)).cast("int")
