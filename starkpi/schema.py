"""Star-schema table definitions.

Money is decimal inside the engine and double at the output edge
(see ``functions.numeric``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (DateType, DecimalType, IntegerType, LongType,
                               StringType, StructField, StructType)

DIM_PRODUCT = StructType([
    StructField("product_id", LongType(), False),
    StructField("product_name", StringType(), False),
    StructField("category", StringType(), False),
    StructField("sub_category", StringType(), False),
    StructField("unit_cost", DecimalType(10, 2), False),
])

DIM_CUSTOMER = StructType([
    StructField("customer_id", LongType(), False),
    StructField("customer_name", StringType(), False),
    StructField("segment", StringType(), False),
    StructField("country", StringType(), False),
    StructField("region", StringType(), False),
])

DIM_DATE = StructType([
    StructField("date_id", DateType(), False),
    StructField("day", IntegerType(), False),
    StructField("month", IntegerType(), False),
    StructField("month_name", StringType(), False),
    StructField("quarter", IntegerType(), False),
    StructField("year", IntegerType(), False),
    StructField("is_weekend", IntegerType(), False),
])

FACT_SALES = StructType([
    StructField("line_id", LongType(), True),
    # text, as the source's ids are (ORD-000123, ORD<epoch seconds>)
    StructField("order_id", StringType(), False),
    StructField("line_number", IntegerType(), True),
    StructField("order_date", DateType(), False),
    StructField("ship_date", DateType(), True),
    StructField("customer_id", LongType(), False),
    StructField("product_id", LongType(), False),
    StructField("supplier_id", LongType(), True),
    StructField("quantity", IntegerType(), False),
    StructField("unit_price", DecimalType(18, 2), False),
    StructField("discount", DecimalType(4, 2), False),
    StructField("sales_amount", DecimalType(18, 2), False),
    StructField("profit", DecimalType(18, 2), False),
])

# Raw fact rows as they arrive from CSV, before cleaning: every field is
# nullable so that cleaning and quality checks can see bad input.
FACT_SALES_INPUT = StructType([StructField(f.name, f.dataType, True) for f in FACT_SALES.fields])

TABLES = {
    "dim_product": DIM_PRODUCT,
    "dim_customer": DIM_CUSTOMER,
    "dim_date": DIM_DATE,
    "fact_sales": FACT_SALES,
}

# Load order: dimensions before facts, so foreign keys resolve.
LOAD_ORDER = ["dim_product", "dim_customer", "dim_date", "fact_sales"]

PRIMARY_KEYS = {
    "dim_product": ["product_id"],
    "dim_customer": ["customer_id"],
    "dim_date": ["date_id"],
    "fact_sales": ["line_id"],
}

NOT_NULL = {name: [f.name for f in s.fields if not f.nullable] for name, s in TABLES.items()}


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """An empty DataFrame with the full schema of a star table."""
    return spark.createDataFrame([], TABLES[name])


def conform(df: DataFrame, name: str, keep: list[str] | None = None) -> DataFrame:
    """Select a table's columns by name, cast to its types; missing columns
    become NULL (as an INSERT that omits them).  ``keep`` columns (e.g. a
    partition column) are passed through as they are."""
    from pyspark.sql import functions as F
    cols = [F.col(k) for k in (keep or [])]
    have = set(df.columns)
    for f in TABLES[name].fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols[len(keep or []):], *cols[:len(keep or [])])
