"""The test star, dirtied by a rule, for queries whose checks clean data never meets.

Every row of the given tables takes part; what is changed follows from the row's keys
alone, so the same rule can be stated in SQL (``oracle.DIRTY_CTES``).  The moduli below are
that rule's only parameters.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from starkpi.sources.star import Star

# Fixed values of the rule: (modulus, remainder) of the order, product or customer id.
NULL_LINE_NUMBER, NULL_PRODUCT, ORPHAN_PRODUCT = (41, 5), (101, 0), (79, 4)
NULL_CUSTOMER, ORPHAN_CUSTOMER = (107, 6), (83, 3)
ZERO_QUANTITY, NULL_PRICE, NULL_DISCOUNT, SECOND_COPY = (97, 1), (89, 2), (113, 7), (53, 0)
UNSOLD, TWICE, NO_KEY = (10, 0), (20, 1), (50, 2)
ORPHAN_SHIFT, UNSOLD_SHIFT = 1_000_000_000, 500_000_000
CALENDAR_END = "1998-01-01"

# Integers that may be NULL in these queries leave as text, which every reader takes alike.
TEXT_COLUMNS = {
    "clean_dedup": ["line_number", "product_id", "customer_id"], "clean_fact": ["line_number"],
    "explore_products": ["units_sold"],
}


def _hit(column: str, rule: tuple[int, int]):
    return F.col(column) % rule[0] == rule[1]


def dirty_star(star: Star) -> Star:
    """Facts with NULLs, zero quantities, missing parents and second copies; dimensions with
    unsold rows, rows that share a key and rows without one; a calendar that ends early."""
    def null_if(column, rule, otherwise=None):
        value = F.col(column) if otherwise is None else otherwise
        return F.when(_hit("order_id", rule), F.lit(None)).otherwise(value).alias(column)

    def shifted(column, rule):
        return F.when(_hit("order_id", rule), F.col(column) + ORPHAN_SHIFT).otherwise(F.col(column))

    changed = {
        "line_number": null_if("line_number", NULL_LINE_NUMBER),
        "product_id": null_if("product_id", NULL_PRODUCT, shifted("product_id", ORPHAN_PRODUCT)),
        "customer_id": null_if("customer_id", NULL_CUSTOMER, shifted("customer_id", ORPHAN_CUSTOMER)),
        "quantity": F.when(_hit("order_id", ZERO_QUANTITY), F.lit(0)).otherwise(F.col("quantity")).alias("quantity"),
        "unit_price": null_if("unit_price", NULL_PRICE),
        "discount": null_if("discount", NULL_DISCOUNT),
    }
    fact = star.fact.select(*[changed.get(c, F.col(c)) for c in star.fact.columns])
    copies = fact.where(_hit("order_id", SECOND_COPY)).withColumn("quantity", F.col("quantity") + 1)
    return Star(fact=fact.unionByName(copies), product=_dirty_dimension(star.product, "product_id", "product_name"),
                customer=_dirty_dimension(star.customer, "customer_id", "customer_name"),
                date=star.date.where(F.col("date_id") < F.lit(CALENDAR_END).cast("date")), tasks=star.tasks)


def _dirty_dimension(df, key: str, name: str):
    def extra(rule, new_key, prefix):
        cols = {key: new_key.cast(df.schema[key].dataType).alias(key), name: F.concat(F.lit(prefix), F.col(name)).alias(name)}
        return df.where(_hit(key, rule)).select(*[cols.get(c, F.col(c)) for c in df.columns])

    return df.unionByName(extra(UNSOLD, F.col(key) + UNSOLD_SHIFT, "IDLE ")) \
        .unionByName(extra(TWICE, F.col(key), "COPY ")).unionByName(extra(NO_KEY, F.lit(None), "LOST "))
