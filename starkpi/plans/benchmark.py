"""Query timing (D12) and the layout benchmark.

A run is one execution of a freshly built DataFrame through the ``noop``
sink: the whole plan executes, nothing is collected.
"""

from __future__ import annotations

import contextlib
import io
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starkpi.plans.explorer import bench_month_product
from starkpi.plans.layout import write_fact
from starkpi.sources.star import Star

N_RUNS = 5


def time_query(build: Callable[[], DataFrame], runs: int = N_RUNS) -> dict:
    """Average, min and max seconds of ``runs`` executions."""
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    return {"avg": sum(times) / len(times), "min": min(times), "max": max(times), "runs": times}


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def gain_pct(before: float, after: float) -> float:
    """percentage gain (before - after) / before * 100, 0 if before <= 0."""
    return (before - after) / before * 100 if before > 0 else 0.0


def month_query(star: Star, start: str, end: str, partitioned: bool) -> DataFrame:
    """D11 on a plain or a month-partitioned fact.  On the month layout the
    query itself adds the derived ``order_month`` predicate (see
    ``Star.date_predicate``), so Parquet partition pruning applies."""
    if partitioned and "order_month" not in star.fact.columns:
        raise ValueError("a month-partitioned fact must carry order_month")
    return bench_month_product(star, start, end)


def layout_benchmark(spark: SparkSession, star: Star, root: str, start: str, end: str,
                     runs: int = N_RUNS) -> dict:
    """The month x product query on a plain and on a month-partitioned,
    sorted copy of the fact; average gain and the formatted plan."""
    plain, by_month = f"{root}/fact_plain", f"{root}/fact_by_month"
    write_fact(star.fact, plain, "plain")
    write_fact(star.fact, by_month, "by_month")

    def on(path, partitioned):
        return lambda: month_query(star.with_fact(spark.read.parquet(path)), start, end, partitioned)

    before = time_query(on(plain, False), runs)
    after = time_query(on(by_month, True), runs)
    plan = explain_text(on(by_month, True)())
    return {"plain": before, "by_month": after, "gain_pct": gain_pct(before["avg"], after["avg"]),
            "plan": plan}


def run_benchmark(spark: SparkSession, star: Star, root: str, start: str, end: str,
                  log_path: str | None = None, runs: int = N_RUNS) -> dict:
    """D13 + S12: the layout benchmark, optionally written as the text log
    that ``sources.io.parse_benchmark_log`` reads back."""
    from starkpi.sources.io import write_benchmark_log
    res = layout_benchmark(spark, star, root, start, end, runs)
    if log_path:
        write_benchmark_log(spark, log_path, res["plain"], res["by_month"], res["gain_pct"])
    return res
