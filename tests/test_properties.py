"""Property tests: cleaning and filters against a direct pandas restatement
of the reference semantics, on random small inputs with duplicates, NULLs
and invalid values."""

import datetime as dt
from decimal import ROUND_HALF_UP
from decimal import Decimal as D

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starkpi.operators import clean
from starkpi.operators.filters import SalesFilter

RAW_DDL = ("line_id long, order_date date, customer_id long, product_id long, quantity int, "
           "unit_price decimal(18,2), discount decimal(4,2)")
ORDER = ["order_date", "customer_id", "product_id", "quantity", "unit_price", "discount"]

row = st.tuples(
    st.integers(1, 6),
    st.one_of(st.none(), st.dates(dt.date(2024, 1, 1), dt.date(2024, 1, 20))),
    st.one_of(st.none(), st.integers(1, 3)),
    st.integers(1, 3),
    st.one_of(st.none(), st.integers(-1, 4)),
    st.one_of(st.none(), st.sampled_from([D("0.00"), D("9.99"), D("10.05"), D("-1.00")])),
    st.one_of(st.none(), st.sampled_from([D("0.00"), D("0.05"), D("0.15")])),
)


def _pandas_clean(rows):
    """Reference semantics: keep first per line_id in ORDER order, drop rows
    missing required fields, keep positive quantity and price, recompute."""
    df = pd.DataFrame(rows, columns=["line_id"] + ORDER)

    def sort_key(r):  # ascending, NULLs first, as in the Spark ordering
        return tuple((v is not None, v if v is not None else 0) for v in r[1:])
    first = {}
    for r in sorted(rows, key=sort_key):
        first.setdefault(r[0], r)
    df = pd.DataFrame(list(first.values()), columns=["line_id"] + ORDER)
    df = df.dropna(subset=["order_date", "customer_id", "product_id", "quantity", "unit_price"])
    df = df[(df["quantity"] > 0) & (df["unit_price"].map(lambda v: v > 0))]
    out = set()
    for r in df.itertuples(index=False):
        amt = None if r.discount is None or pd.isna(r.discount) else \
            (D(int(r.quantity)) * r.unit_price * (1 - r.discount)).quantize(D("0.01"), ROUND_HALF_UP)
        out.add((int(r.line_id), amt))
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=0, max_size=25))
def test_clean_fact_matches_pandas(spark, rows):
    df = spark.createDataFrame(rows, RAW_DDL)
    got = {(r["line_id"], r["sales_amount"]) for r in clean.clean_fact(df, ["line_id"], ORDER).collect()}
    assert got == _pandas_clean(rows)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 50), st.dates(dt.date(2024, 1, 1), dt.date(2024, 3, 1)),
                          st.sampled_from(["A", "B", "C"]), st.sampled_from(["X", "Y", "Z"])), max_size=30),
       st.one_of(st.none(), st.dates(dt.date(2024, 1, 1), dt.date(2024, 3, 1))),
       st.one_of(st.none(), st.dates(dt.date(2024, 1, 1), dt.date(2024, 3, 1))),
       st.lists(st.sampled_from(["A", "B", "C"]), max_size=2, unique=True),
       st.lists(st.sampled_from(["X", "Y", "Z"]), max_size=2, unique=True))
def test_filter_matches_python(spark, rows, start, end, cats, countries):
    df = spark.createDataFrame(rows, "id int, order_date date, category string, country string")
    flt = SalesFilter(start, end, cats, countries)
    got = sorted(r["id"] for r in df.filter(flt.predicate()).collect())
    want = sorted(i for i, d, c, k in rows
                  if (start is None or d >= start) and (end is None or d <= end)
                  and (not cats or c in cats) and (not countries or k in countries))
    assert got == want
