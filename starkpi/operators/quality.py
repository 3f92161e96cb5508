"""Data-quality checks that replace the database constraints.

Each check is one distributed pass that returns a small report DataFrame;
``assert_clean`` turns a report into an exception for pipelines that must
stop on a breach.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, table: str, cols: list[str] | None = None) -> DataFrame:
    """NULL count per column, one row per (table_name, column_name)."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count").select(
        F.lit(table).alias("table_name"), "column_name", F.col("null_count").cast("long"))


def duplicate_keys(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of copies.  Keys are
    compared as they are (NULLs are equal) and only then rendered as text
    (``a|b``, NULL as such), so that tables with different keys union."""
    key_text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
            .select(F.lit(table).alias("table_name"), key_text.alias("key_value"), "copies"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose foreign key has no parent row (anti join)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    return child.join(p, child[child_key] == p["__pk"], "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                 check: str) -> DataFrame:
    """Number of orphan rows of one foreign key."""
    return orphans(child, parent, child_key, parent_key).agg(
        F.count(F.lit(1)).alias("orphan_rows")).select(F.lit(check).alias("check_name"), "orphan_rows")


def orphan_report(child: DataFrame, checks: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """C10 for several foreign keys in one pass over ``child``: each check
    ``(name, parent, child_key, parent_key)`` left-joins the parent's
    distinct keys (no row can multiply) and counts the rows without a match.
    One row per check: (check_name, orphan_rows)."""
    j = child.select(*sorted({ck for _, _, ck, _ in checks}))
    for i, (_, parent, ck, pk) in enumerate(checks):
        p = parent.select(F.col(pk).alias(f"__pk{i}")).distinct().withColumn(f"__hit{i}", F.lit(True))
        j = j.join(p, j[ck] == p[f"__pk{i}"], "left")
    wide = j.agg(*[F.count_if(F.col(f"__hit{i}").isNull()).alias(f"c{i}") for i in range(len(checks))])
    names = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").cast("long").alias("orphan_rows"))
                      for i, (n, _, _, _) in enumerate(checks)])
    return wide.select(F.explode(names).alias("r")).select("r.check_name", "r.orphan_rows")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def assert_clean(report: DataFrame, count_col: str) -> None:
    """Raise if any row of a report has a positive count; the text gives the number
    of such rows and, as examples, up to 20 of them."""
    bad = report.filter(F.col(count_col) > 0)
    examples = bad.limit(20).collect()
    if examples:
        raise ValueError(f"data-quality breach in {bad.count()} rows, such as {[r.asDict() for r in examples]}")
