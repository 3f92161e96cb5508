"""The reference's four unit cases, plus the cleaning edge fixtures."""

import datetime as dt
from decimal import Decimal as D

from starkpi.operators import clean

RAW_DDL = ("line_id long, order_date date, customer_id long, product_id long, quantity int, "
           "unit_price decimal(18,2), discount decimal(4,2)")
ORDER = ["order_date", "customer_id", "product_id", "quantity", "unit_price", "discount"]


def _raw(spark, rows):
    return spark.createDataFrame(
        [(a, dt.date.fromisoformat(b) if b else None, c, e, f, None if g is None else D(str(g)),
          None if h is None else D(str(h))) for a, b, c, e, f, g, h in rows], RAW_DDL)


def _clean(df):
    return clean.clean_fact(df, ["line_id"], ORDER)


def test_drops_duplicates(spark):
    df = _raw(spark, [(1, "2024-01-01", 1, 1, 2, 10.0, 0.0), (1, "2024-01-01", 1, 1, 2, 10.0, 0.0),
                      (2, "2024-01-02", 2, 2, 3, 20.0, 0.1)])
    assert _clean(df).count() == 2


def test_drops_invalid_quantity(spark):
    df = _raw(spark, [(1, "2024-01-01", 1, 1, 0, 10.0, 0.0), (2, "2024-01-02", 2, 2, 3, 20.0, 0.1)])
    assert _clean(df).count() == 1


def test_recomputes_sales_amount(spark):
    df = _raw(spark, [(1, "2024-01-01", 1, 1, 2, 100.0, 0.1)])
    assert float(_clean(df).first()["sales_amount"]) == 180.0


def test_dimension_drops_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "product_id long, name string")
    assert clean.clean_dimension(df, "product_id").count() == 2


def test_bad_first_copy_hides_good_second(spark):
    # de-dup precedes filtering: the first copy (quantity 0) wins, then is dropped
    df = _raw(spark, [(7, "2024-01-01", 1, 1, 0, 10.0, 0.0), (7, "2024-01-01", 1, 1, 5, 10.0, 0.0)])
    assert _clean(df).count() == 0


def test_null_discount_survives_with_null_amount(spark):
    df = _raw(spark, [(1, "2024-01-01", 1, 1, 2, 10.0, None)])
    out = _clean(df).collect()
    assert len(out) == 1 and out[0]["sales_amount"] is None


def test_null_required_field_dropped(spark):
    df = _raw(spark, [(1, None, 1, 1, 2, 10.0, 0.0), (2, "2024-01-01", None, 1, 2, 10.0, 0.0),
                      (3, "2024-01-01", 1, 1, 2, 10.0, 0.0)])
    assert _clean(df).count() == 1


def test_null_keys_are_one_group(spark):
    df = _raw(spark, [(None, "2024-01-01", 1, 1, 2, 10.0, 0.0), (None, "2024-01-02", 1, 1, 2, 10.0, 0.0)])
    assert clean.dedup_first(df, ["line_id"], ORDER).count() == 1


def test_dedup_keeps_first_in_order(spark):
    df = _raw(spark, [(1, "2024-01-03", 1, 1, 2, 10.0, 0.0), (1, "2024-01-01", 9, 1, 2, 10.0, 0.0),
                      (1, "2024-01-02", 1, 1, 2, 10.0, 0.0)])
    got = clean.dedup_first(df, ["line_id"], ORDER).collect()
    assert len(got) == 1 and got[0]["customer_id"] == 9 and got[0].asDict()["line_id"] == 1


def test_dedup_with_input_order(spark, tmp_out):
    df = _raw(spark, [(1, "2024-01-03", 3, 1, 2, 10.0, 0.0), (1, "2024-01-01", 1, 1, 2, 10.0, 0.0)])
    df.coalesce(1).write.mode("overwrite").parquet(tmp_out + "/raw")
    back = clean.with_input_order(spark.read.parquet(tmp_out + "/raw"))
    got = clean.dedup_first(back, ["line_id"], ["_input_order"]).collect()
    assert got[0]["customer_id"] == 3  # the first row of the file, not the smallest


def test_clean_report_counts(spark):
    df = _raw(spark, [(1, "2024-01-01", 1, 1, 2, 10.0, 0.0), (1, "2024-01-01", 1, 1, 2, 10.0, 0.0),
                      (2, None, 1, 1, 2, 10.0, 0.0), (3, "2024-01-01", 1, 1, 0, 10.0, 0.0),
                      (4, "2024-01-01", 1, 1, 1, 10.0, 0.0)])
    r = clean.clean_report(df, ["line_id"], ORDER).first().asDict()
    assert r == {"rows_before": 5, "rows_after_dedup": 4, "rows_after_not_null": 3,
                 "rows_after": 2, "rows_dropped": 3}


def test_dedup_is_combined_before_the_shuffle(spark):
    import contextlib
    import io
    df = _raw(spark, [(1, "2024-01-01", 1, 1, 2, 10.0, 0.0)] * 50 + [(2, "2024-01-02", 2, 2, 3, 20.0, 0.1)])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        clean.dedup_first(df, ["line_id"], ORDER).explain()
    plan = buf.getvalue()
    # a group limit sits below the exchange too: a hot key moves one row per map task
    assert plan.index("Exchange hashpartitioning(line_id") < plan.rindex("WindowGroupLimit")
