"""Quality reports with real breaches (the test data has none)."""

import pytest

from starkpi.operators import quality
from starkpi.plans import lines
from tests.fixtures import line, small_star


def test_orphans_of_every_key(spark):
    s = small_star(spark, [line(1, 1, 1, 1, "2024-01-05", 1, 10, 0, 10, 1),
                           line(2, 1, 99, 1, "2024-01-05", 1, 10, 0, 10, 1),    # unknown product
                           line(3, 1, 1, 77, "2024-01-05", 1, 10, 0, 10, 1),    # unknown customer
                           line(4, 1, 1, 1, "2030-01-01", 1, 10, 0, 10, 1),     # outside calendar
                           line(5, 1, 98, 76, "2031-01-01", 1, 10, 0, 10, 1)])  # all three
    got = {r["check_name"]: r["orphan_rows"] for r in lines.star_orphans(s).collect()}
    assert got == {"fact_sales.order_date -> dim_date": 2, "fact_sales.customer_id -> dim_customer": 2,
                   "fact_sales.product_id -> dim_product": 2}


def test_null_foreign_key_is_an_orphan(spark):
    child = spark.createDataFrame([(1,), (None,)], "k long")
    parent = spark.createDataFrame([(1,), (1,)], "k long")
    r = quality.orphan_report(child, [("k", parent, "k", "k")]).first()
    assert r["orphan_rows"] == 1


def test_null_counts_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None), (None, "x")], "id long, name string")
    nulls = {r["column_name"]: r["null_count"] for r in quality.null_counts(df, "t").collect()}
    assert nulls == {"id": 1, "name": 2}
    dups = [(r["key_value"], r["copies"]) for r in quality.duplicate_keys(df, "t", ["id"]).collect()]
    assert dups == [("1", 2)]
    with pytest.raises(ValueError):
        quality.assert_clean(quality.null_counts(df, "t"), "null_count")
    quality.assert_clean(quality.null_counts(df.dropna(), "t"), "null_count")


def test_duplicate_keys_compare_real_values(spark):
    df = spark.createDataFrame([(5, None, "x|y", "z"), (None, 5, "x", "y|z"), (None, 5, "q", "q")],
                               "a long, b long, c string, d string")
    assert [(r["key_value"], r["copies"]) for r in quality.duplicate_keys(df, "t", ["a", "b"]).collect()] == [("NULL|5", 2)]
    assert quality.duplicate_keys(df, "t", ["c", "d"]).collect() == []


def test_breaches_are_counted(spark):
    report = spark.range(30).selectExpr("id", "1 AS copies")
    with pytest.raises(ValueError, match="30 rows"):
        quality.assert_clean(report, "copies")


def test_duplicate_fact_keys_in_star(spark):
    s = small_star(spark, [line(1, 1, 1, 1, "2024-01-05", 1, 10, 0, 10, 1),
                           line(1, 1, 2, 1, "2024-01-05", 1, 10, 0, 10, 1),
                           line(1, 2, 1, 1, "2024-01-05", 1, 10, 0, 10, 1)])
    got = {(r["table_name"], r["key_value"], r["copies"]) for r in lines.star_duplicate_keys(s).collect()}
    assert got == {("fact_sales", "1|1", 2)}
