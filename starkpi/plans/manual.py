"""Manual sale entry (S14 with F12/F13), as a batch of form entries.

An entry carries (product_id, customer_id, quantity, sale_date, margin_pct,
entered_at).  Pricing follows the entry form: unit price = unit cost x 1.5,
revenue = quantity x unit price, profit = revenue x margin / 100, discount 0.
The order id is ``ORD`` + the entry's epoch second (``functions.pricing.
manual_order_id``); line_id and ship_date are left empty, as the form leaves them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkpi.functions.numeric import MONEY, RATE
from starkpi.functions.pricing import (MANUAL_DEFAULT_MARGIN, manual_order_id, manual_profit,
                                       manual_revenue, manual_unit_price)

ENTRY_DDL = ("product_id long, customer_id long, quantity int, sale_date date, "
             "margin_pct int, entered_at timestamp")


def manual_sales(entries: DataFrame, product: DataFrame) -> DataFrame:
    """Fact rows for form entries; entries for unknown products are dropped
    by the inner join (the form only offers known products)."""
    j = entries.join(product.select("product_id", "unit_cost"), "product_id")
    up = manual_unit_price("unit_cost")
    rev = manual_revenue("quantity", up)
    margin = F.coalesce(F.col("margin_pct"), F.lit(MANUAL_DEFAULT_MARGIN))
    return j.select(
        manual_order_id("entered_at").alias("order_id"),
        F.col("sale_date").alias("order_date"), "customer_id", "product_id",
        F.col("quantity").cast("int").alias("quantity"), up.alias("unit_price"),
        F.lit(0).cast(RATE).alias("discount"), rev.alias("sales_amount"),
        manual_profit(rev, margin).cast(MONEY).alias("profit"))
