"""The load run (S4, S16, S17): extract -> clean -> load -> layout -> views -> log.

Dimensions are written before the fact (S4).  Every step is a Spark job
that writes files; the only values that reach the driver are row counts
(observed during the writes) and timings.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starkpi.operators.clean import clean_dimension, clean_fact
from starkpi.plans.layout import fact_writer
from starkpi.schema import LOAD_ORDER
from starkpi.sources import io, snapshots
from starkpi.sources.star import FACT_COLUMNS, LINE_ORDER, Star

# Line identity of test-data facts, which have no surrogate key (unique there).
TESTDATA_LINE_KEY = list(LINE_ORDER)


def line_key_of(star: Star, line_key: list[str] | None = None) -> list[str]:
    """The columns that identify a fact line: those given, the star's own, or the
    source's surrogate key.  There is no other default: de-duplicating by a key
    that is not one would delete valid lines."""
    key = list(line_key or star.line_key or (["line_id"] if "line_id" in star.fact.columns else []))
    if not key:
        raise ValueError("the fact has no line_id: name the columns that identify a line (line_key)")
    return key


def clean_star(star: Star, line_key: list[str]) -> Star:
    """Cleaning of all four tables (C6, C7).  "First copy" means first in
    file order when the tables carry ``_input_order`` (CSV sources), else
    first by the remaining columns."""
    def order_of(df, key):
        if "_input_order" in df.columns:
            return ["_input_order"]
        return [c for c in df.columns if c not in key]

    def done(df):
        return df.drop("_input_order", io.REJECTED)

    fact_cols = [c for c in (["line_id"] + FACT_COLUMNS + ["_input_order"]) if c in star.fact.columns]
    fact = star.fact.select(*fact_cols)
    return Star(
        fact=done(clean_fact(fact, line_key, order_of(fact, line_key))),
        product=done(clean_dimension(star.product, "product_id", order_of(star.product, ["product_id"]))),
        customer=done(clean_dimension(star.customer, "customer_id", order_of(star.customer, ["customer_id"]))),
        date=done(clean_dimension(star.date, "date_id", order_of(star.date, ["date_id"]))))


def check_constraints(star: Star, line_key: list[str]) -> dict[str, DataFrame]:
    """The database constraints of the source system as reports (C8-C10):
    NULLs in required columns, duplicated primary keys, orphan foreign keys.
    Each report has one count column; any positive count is a breach."""
    from starkpi import schema as S
    from starkpi.operators import quality

    def required(df, table):
        cols = [c for c in S.NOT_NULL[table] if c in df.columns]
        return quality.null_counts(df, table, cols)

    nulls = quality.union_all([required(star.fact, "fact_sales"), required(star.product, "dim_product"),
                               required(star.customer, "dim_customer"), required(star.date, "dim_date")])
    dups = quality.union_all([quality.duplicate_keys(star.fact, "fact_sales", line_key),
                              quality.duplicate_keys(star.product, "dim_product", ["product_id"]),
                              quality.duplicate_keys(star.customer, "dim_customer", ["customer_id"]),
                              quality.duplicate_keys(star.date, "dim_date", ["date_id"])])
    orphans = quality.orphan_report(star.fact, [
        ("fact_sales.order_date -> dim_date", star.date, "order_date", "date_id"),
        ("fact_sales.customer_id -> dim_customer", star.customer, "customer_id", "customer_id"),
        ("fact_sales.product_id -> dim_product", star.product, "product_id", "product_id")])
    return {"null_count": nulls, "copies": dups, "orphan_rows": orphans}


def enforce_constraints(star: Star, line_key: list[str]) -> None:
    """Raise ValueError on the first breached constraint (nothing is written)."""
    from starkpi.operators.quality import assert_clean
    for count_col, report in check_constraints(star, line_key).items():
        assert_clean(report, count_col)


def load_star(star: Star, root: str, layout: str = "by_month") -> dict:
    """Write the star under ``root``: dims plain, the fact in ``layout``.

    Load order (S4): the three dimensions are written first, as concurrent
    Spark jobs (they are independent and small, so their per-job latency
    overlaps), and the fact only after all three have committed.  Rows are
    counted by observation of each write."""
    report = {}
    dims = [("dim_product", star.product), ("dim_customer", star.customer), ("dim_date", star.date)]
    with ThreadPoolExecutor(max_workers=len(dims)) as pool:
        futures = {name: pool.submit(io.bulk_load, df, f"{root}/{name}", name, "overwrite")
                   for name, df in dims}
        for name, fut in futures.items():
            report[name] = fut.result()
    t0 = time.perf_counter()
    obs = Observation("fact_rows")
    fact_writer(star.fact, layout, observation=obs).parquet(f"{root}/fact_sales")
    report["fact_sales"] = {"table": "fact_sales", "rows": obs.get["rows"], "seconds": time.perf_counter() - t0}
    return report


def _observed(star: Star) -> tuple[Star, dict[str, Observation]]:
    """The star's tables, each counting the values that could not be read while it is loaded."""
    seen: dict[str, Observation] = {}

    def watched(df: DataFrame, name: str) -> DataFrame:
        if io.REJECTED not in df.columns:
            return df
        seen[name] = Observation(f"rejected_{name}")
        return io.observe_rejected(df, seen[name])

    return replace(star, fact=watched(star.fact, "fact_sales"), product=watched(star.product, "dim_product"),
                   customer=watched(star.customer, "dim_customer"), date=watched(star.date, "dim_date")), seen


def publish_star(spark: SparkSession, star: Star, root: str, layout: str = "by_month",
                 check: Callable[[], None] | None = None) -> dict:
    """``load_star`` into a version folder of its own below ``root``, which readers see as soon
    as all four tables are written, and not before: a load that dies leaves the star that was
    there, and so does a ``check`` of the written tables that raises."""
    version, folder = snapshots.new_folder(spark, root)
    report = load_star(star, f"{root}/{folder}", layout)
    if check is not None:
        check()
    snapshots.publish(spark, root, version, folder, fact_rows=report["fact_sales"]["rows"])
    return report


def run_pipeline(spark: SparkSession, star: Star, root: str, layout: str = "by_month",
                 line_key: list[str] | None = None, log_path: str | None = None,
                 enforce: bool = False) -> dict:
    """Full refresh of the star under ``root``, published in one commit.

    Returns per-table rows/seconds, the load seconds (cleaning + writes, the
    figure the run log records), the seconds spent registering the views,
    and the view names (the star is re-read from ``root``).  With
    ``enforce`` the source system's constraints (required columns, primary
    keys, foreign keys) are checked on the cleaned star first and a breach
    raises before anything is written; it costs extra passes over the facts.  Values of
    CSV sources that cannot be read as their column's type are counted by the load itself and
    reported under ``cast_failures`` (at most a row per column); with ``enforce`` they raise
    too, before the load is published.  Lines are identified by ``line_key_of``.  All views
    are lazy."""
    t0 = time.perf_counter()
    key = line_key_of(star, line_key)
    if enforce:  # the source system's NOT NULL / PK / FK constraints, checked before any write
        enforce_constraints(clean_star(star, key), key)
    watched, seen = _observed(star)
    failures: list[dict] = []

    def check():
        failures.extend(row for name in LOAD_ORDER if name in seen for row in io.rejected_values(seen[name], name))
        if enforce and failures:
            raise ValueError(f"values that cannot be read as their column's type: {failures}")

    report = publish_star(spark, clean_star(watched, key), root, layout, check)
    total = time.perf_counter() - t0
    t1 = time.perf_counter()
    loaded = Star.from_layout(spark, root)
    views = io.register_views(spark, loaded)
    views_s = time.perf_counter() - t1
    if log_path:
        io.append_run_log(spark, log_path, _dt.datetime.now(), report["fact_sales"]["rows"], total)
    return {"tables": report, "total_load_seconds": total, "views_seconds": views_s, "views": views,
            "cast_failures": failures}


def load_star_tables(star: Star, prefix: str = "", layout: str = "by_month", customer_buckets: int | None = None) -> dict:
    """S3 with managed tables: the star as catalog tables ``<prefix>dim_product``,
    ``<prefix>dim_customer``, ``<prefix>dim_date``, ``<prefix>fact_sales``
    (dims first; the fact rebalanced, sorted and partitioned by month).
    Returns rows per table, observed during the writes.

    With ``customer_buckets`` the facts and the customers are bucketed by customer instead,
    ``customer_rfm`` and other joins and groups by customer then need no shuffle of the facts.
    One task reads a bucket: where a single customer holds a large share of all lines, leave
    the tables unbucketed, so that the shuffle can spread that customer's lines."""
    if customer_buckets and layout != "plain":
        raise ValueError("buckets replace the months: layout must be 'plain'")

    def bucketed(writer):
        return writer.bucketBy(customer_buckets, "customer_id").sortBy("customer_id") if customer_buckets else writer

    report = {}
    for name, df in [("dim_product", star.product), ("dim_customer", star.customer), ("dim_date", star.date)]:
        obs = Observation(f"rows_{name}")
        writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        (bucketed(writer) if name == "dim_customer" else writer).saveAsTable(prefix + name)
        report[name] = obs.get["rows"]
    obs = Observation("rows_fact_sales")
    # as many parts as buckets, dealt alike: a task writes one bucket, a hot one's rows several tasks
    fact = star.fact.hint("rebalance", customer_buckets, "customer_id") if customer_buckets else star.fact
    bucketed(fact_writer(fact, layout, observation=obs)).saveAsTable(prefix + "fact_sales")
    report["fact_sales"] = obs.get["rows"]
    return report
