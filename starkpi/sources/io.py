"""Sources and sinks.

Everything is written by Spark tasks; nothing passes whole through the
driver.  Result sets written as one file (exports) are bounded by their
query (a LIMIT, or one row per category/country/month).
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starkpi import schema as S
from starkpi.functions import formatting as fmt

# ---- S1: CSV scan -------------------------------------------------------


REJECTED = "_rejected"


def read_csv(spark: SparkSession, path: str, struct: StructType, input_order: bool = False, rejected: bool = False) -> DataFrame:
    """CSV with header, UTF-8.  Columns are matched to ``struct`` by header
    name (not position) and converted with ``try_cast``: an unparsable value
    becomes NULL, to be caught by cleaning and counted by ``cast_failures``.
    Columns the file lacks are NULL.  No inference pass: every field is read as
    text first.  With
    ``input_order`` an ``_input_order`` column records the file order, for
    "keep the first copy" de-duplication; with ``rejected`` a ``_rejected`` column holds
    each row's texts that became NULL, by column, for ``observe_rejected``."""
    from starkpi.operators.clean import with_input_order
    raw = _csv_text(spark, path)
    have = set(raw.columns)
    extra = []
    if input_order:
        raw = with_input_order(raw)
        extra = [F.col("_input_order")]
    typed = _typed(struct, have)
    if rejected and typed:
        extra.append(F.struct(*[_rejected_text(f).alias(f.name) for f in typed]).alias(REJECTED))
    return raw.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have
                         else F.lit(None).cast(f.dataType)).alias(f.name) for f in struct.fields], *extra)


def _csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Every field as text under the first file's header.  Each file's own header is
    checked against it: a file with other columns or another order fails instead
    of being mapped by position."""
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    names = reader.option("inferSchema", False).csv(path).columns
    text = StructType([StructField(c, StringType(), True) for c in names])
    return reader.option("enforceSchema", False).schema(text).csv(path)


def _typed(struct: StructType, have) -> list[StructField]:
    return [f for f in struct.fields if f.name in have and not isinstance(f.dataType, StringType)]


def _rejected_text(f: StructField):
    """The field's text where it is one that cannot be read as the field's type."""
    return F.when((F.trim(f.name) != "") & F.col(f.name).try_cast(f.dataType).isNull(), F.col(f.name))


def observe_rejected(df: DataFrame, observation: Observation) -> DataFrame:
    """``df`` of ``read_csv(..., rejected=True)`` without its ``_rejected`` column, whose texts
    the first job over the result counts as it reads them (no scan of their own)."""
    names = df.schema[REJECTED].dataType.names
    metrics = [m for c in names for m in (F.count(f"{REJECTED}.{c}").alias(f"failed_{c}"), F.min(f"{REJECTED}.{c}").alias(f"example_{c}"))]
    return df.observe(observation, *metrics).drop(REJECTED)


def rejected_values(observation: Observation, table: str) -> list[dict]:
    """What ``cast_failures`` reports, of an observed job that has ended.  Rows that were read
    again after an executor was lost may count again."""
    got = observation.get
    names = [k.removeprefix("failed_") for k in got if k.startswith("failed_")]
    return [{"table_name": table, "column_name": c, "failed": got[f"failed_{c}"], "example": got[f"example_{c}"]}
            for c in names if got[f"failed_{c}"]]


def cast_failures(spark: SparkSession, path: str, struct: StructType, table: str = "") -> DataFrame:
    """(table_name, column_name, failed, example): non-empty values that cannot be
    read as their column's type, one row per column that has any."""
    raw = _csv_text(spark, path)
    typed = _typed(struct, raw.columns)
    if not typed:
        return spark.createDataFrame([], "table_name string, column_name string, failed long, example string")

    wide = raw.agg(*[F.struct(F.count(_rejected_text(f)).alias("failed"), F.min(_rejected_text(f)).alias("example")).alias(f.name)
                     for f in typed])
    each = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").alias("r")) for f in typed])
    return wide.select(F.explode(each).alias("c")).select(
        F.lit(table).alias("table_name"), "c.column_name", "c.r.failed", "c.r.example").filter("failed > 0")


def star_cast_failures(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``cast_failures`` of the four source files."""
    parts = [cast_failures(spark, paths[n], S.FACT_SALES_INPUT if n == "fact_sales" else S.TABLES[n], n) for n in S.LOAD_ORDER]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_star_csv(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The four source files of the star, fact read with nullable columns."""
    out = {}
    for name in S.LOAD_ORDER:
        struct = S.FACT_SALES_INPUT if name == "fact_sales" else S.TABLES[name]
        struct = StructType([f.__class__(f.name, f.dataType, True) for f in struct.fields])
        out[name] = read_csv(spark, paths[name], struct, input_order=True, rejected=True)
    return out


# ---- S2/S3/S4: schema and loads -----------------------------------------


def create_empty_star(spark: SparkSession, root: str) -> None:
    """(re)create all four tables empty with their full schema; fact first
    is irrelevant for files, the overwrite makes each run a full refresh."""
    for name in reversed(S.LOAD_ORDER):
        S.empty_table(spark, name).write.mode("overwrite").parquet(f"{root}/{name}")


def bulk_load(df: DataFrame, path: str, table: str, mode: str = "append",
              partition_by: list[str] | None = None) -> dict:
    """S3: write ``df`` (columns matched by name to the table schema) and
    report rows and seconds.  The row count is an observed metric of the
    write itself, not a second pass."""
    obs = Observation(f"load_{table}")
    keep = [c for c in (partition_by or []) if c not in S.TABLES.get(table, S.FACT_SALES).names]
    out = S.conform(df, table, keep) if table in S.TABLES else df
    t0 = time.perf_counter()
    w = out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return {"table": table, "rows": obs.get["rows"], "seconds": time.perf_counter() - t0}


# ---- S5/S6/S7: SQL access and views ---------------------------------------


def run_query(spark: SparkSession, sql: str, label: str = "", args: dict | list | None = None):
    """Run SQL (optionally with named/positional parameters), time it
    with a no-op write, and return (DataFrame, seconds)."""
    df = spark.sql(sql, args=args) if args is not None else spark.sql(sql)
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return df, time.perf_counter() - t0


def register_views(spark: SparkSession, star) -> list[str]:
    """Star tables and the six KPI views as temporary views."""
    from starkpi.plans import kpis
    views = {
        "fact_sales": star.fact, "dim_product": star.product,
        "dim_customer": star.customer, "dim_date": star.date,
        "vw_kpi_summary": kpis.kpi_summary(star),
        "vw_monthly_revenue": kpis.monthly_revenue(star),
        "vw_product_performance": kpis.product_performance(star),
        "vw_category_performance": kpis.category_performance(star),
        "vw_regional_performance": kpis.regional_performance(star),
        "vw_customer_rfm": kpis.customer_rfm(star),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


# ---- S8/S9: exports ------------------------------------------------------


def export_csv(df: DataFrame, path: str) -> None:
    """Result with header as CSV files."""
    df.write.option("header", True).mode("overwrite").csv(path)


def _json_array(df: DataFrame, max_rows: int):
    """A bounded, ordered result as one JSON array string (scalar subquery).
    Rows are numbered on one partition, collected with their number and sorted
    by it, so the array keeps the query order.  A result beyond ``max_rows`` is
    an error: one row more than that is all that ever reaches the partition."""
    one = df.limit(max_rows + 1).coalesce(1).withColumn("__i", F.monotonically_increasing_id())
    arr = F.sort_array(F.collect_list(F.struct("__i", F.struct(*df.columns).alias("r"))))
    too_many = F.raise_error(F.lit(f"a dataset of the document has more than {max_rows} rows"))
    return one.select(F.when(F.size(arr) > max_rows, too_many.cast("string"))
                      .otherwise(F.to_json(arr.getField("r")))).scalar()


def export_document(spark: SparkSession, datasets: dict[str, DataFrame], path: str,
                    extra_json: dict[str, DataFrame | None] | None = None, max_rows: int = 10_000) -> None:
    """One JSON document ``{"name": [rows...], ...}`` written by Spark; a
    dataset of more than ``max_rows`` rows raises (export it as CSV instead).
    ``extra_json`` values are one-row DataFrames whose first column already
    holds JSON text (e.g. the parsed benchmark object), or None for null."""
    parts = []
    for i, (name, df) in enumerate(datasets.items()):
        parts += [F.lit(("{" if i == 0 else ",") + f'"{name}":'), _json_array(df, max_rows)]
    for name, df in (extra_json or {}).items():
        parts += [F.lit(f',"{name}":'), F.lit("null") if df is None
                  else F.coalesce(df.select(df.columns[0]).scalar(), F.lit("null"))]
    parts.append(F.lit("}"))
    spark.range(1).select(F.concat(*parts).alias("value")).coalesce(1) \
        .write.mode("overwrite").text(path)


def dashboard_datasets(star) -> dict[str, DataFrame]:
    """The six exported result sets: column subsets, sorted, capped as in
    the static dashboard (50 products, 200 customers)."""
    from starkpi.plans import kpis
    return {
        "kpi": kpis.kpi_summary(star),
        "monthly": kpis.monthly_revenue(star).orderBy("year", "month"),
        "products": exported_products(star),
        "categories": kpis.category_performance(star).orderBy(F.col("total_revenue").desc(), "category"),
        "regional": kpis.regional_performance(star).orderBy(F.col("total_revenue").desc(), "country"),
        "customers": exported_customers(star),
    }


_PRODUCT_ORDER = ["product_name", "category", "sub_category"]


def exported_products(star, n: int = 50) -> DataFrame:
    """The export's products by revenue, without their rank."""
    from starkpi.plans import kpis
    return kpis.product_list(star).orderBy(F.col("total_revenue").desc(), *_PRODUCT_ORDER).limit(n)


def exported_customers(star, n: int = 200) -> DataFrame:
    """The export's customers by revenue."""
    from starkpi.plans import kpis
    return kpis.top_customers_rfm(star, n)


def export_dashboard(spark: SparkSession, star, path: str, bench_log: str | None = None) -> None:
    """The six dashboard datasets plus the parsed benchmark figures (or
    null when there is no log, or none at its path) as one JSON document."""
    benchmark = None
    if bench_log is not None:
        b = parse_benchmark_log(spark, bench_log)
        benchmark = b.select(F.to_json(F.struct(*b.columns)))
    export_document(spark, dashboard_datasets(star), path, {"benchmark": benchmark})


def page_products(star) -> DataFrame:
    """The products that the static page shows of the export."""
    return exported_products(star, 10)


def page_customers(star) -> DataFrame:
    """The customers that the static page shows of the export."""
    return exported_customers(star, 100)


# ---- S10/S11/S12: run log and benchmark log ---------------------------------


def append_run_log(spark: SparkSession, path: str, run_ts, fact_rows: int, seconds: float) -> None:
    """Append one (timestamp, fact_rows_loaded, total_load_seconds) row."""
    spark.createDataFrame([(run_ts, int(fact_rows), round(float(seconds), 3))],
                          "timestamp timestamp, fact_rows_loaded long, total_load_seconds double") \
        .coalesce(1).write.mode("append").option("header", True).csv(path)


def write_benchmark_log(spark: SparkSession, path: str, before: dict, after: dict, gain: float) -> None:
    """The benchmark result as the three-line text report."""
    def line(label, r):
        return (f"{label} avg={r['avg'] * 1000:.1f}ms (min={r['min'] * 1000:.1f}ms, "
                f"max={r['max'] * 1000:.1f}ms)")
    text = "\n".join(["QUERY PERFORMANCE BENCHMARK", line("Without indexes:", before),
                      line("With indexes:   ", after), f"Speedup: {gain:.1f}%"])
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def parse_benchmark_log(spark: SparkSession, path: str) -> DataFrame:
    """One row (raw, without_avg_ms, with_avg_ms, speedup_pct) per
    log file, no row when there is none.  Lines are matched by label,
    case-insensitively."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "raw string, without_avg_ms double, with_avg_ms double, speedup_pct double")
    whole = text.withColumn("__f", F.input_file_name())
    lines = whole.select("__f", F.col("value").alias("raw"),
                         F.explode(F.split("value", "\n")).alias("line"))
    low = F.lower("line")
    avg = F.regexp_extract("line", fmt.LOG_AVG_PATTERN, 1)
    avg_ms = F.when(avg != "", avg).try_cast("double")
    spd = F.regexp_extract("line", fmt.LOG_SPEEDUP_PATTERN, 1)
    spd_v = F.when(spd != "", spd).try_cast("double")
    is_without = low.contains(fmt.LOG_LABEL_WITHOUT)
    is_with = low.contains(fmt.LOG_LABEL_WITH) & ~is_without
    return lines.groupBy("__f", "raw").agg(
        F.max(F.when(is_without, avg_ms)).alias("without_avg_ms"),
        F.max(F.when(is_with, avg_ms)).alias("with_avg_ms"),
        F.max(F.when(low.contains(fmt.LOG_LABEL_SPEEDUP), spd_v)).alias("speedup_pct")).drop("__f")


# ---- S13: table status --------------------------------------------------------


def catalog_status(spark: SparkSession, names: list[str]) -> DataFrame:
    """Row count per catalog table; a missing table is reported with a
    NULL count and status 'missing', not raised."""
    parts = []
    for n in names:
        if spark.catalog.tableExists(n):
            parts.append(spark.table(n).agg(F.count(F.lit(1)).alias("row_count"))
                         .select(F.lit(n).alias("table_name"), "row_count", F.lit("ok").alias("status")))
        else:
            parts.append(spark.createDataFrame([(n, None, "missing")],
                                               "table_name string, row_count long, status string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- S14: appends ------------------------------------------------------------


def append_sales(new_rows: DataFrame, fact_path: str, partition_by: list[str] | None = None) -> dict:
    """Append sale rows to the fact table; missing columns (line_id,
    ship_date, ...) become NULL, as in an INSERT that omits them."""
    rows = new_rows
    if partition_by and "order_month" in partition_by and "order_month" not in rows.columns:
        rows = rows.withColumn("order_month", F.trunc("order_date", "month"))
    return bulk_load(rows, fact_path, "fact_sales", mode="append", partition_by=partition_by)


# ---- S15: JDBC pass-through (no driver in this environment: untested) -------


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()


def timed(action: Callable[[], object]) -> float:
    t0 = time.perf_counter()
    action()
    return time.perf_counter() - t0
