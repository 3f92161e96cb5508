"""Line pricing and identifiers.

All money arithmetic is decimal, so results are exact and independent of
partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starkpi.functions.numeric import MONEY, RATE, UNIT_COST


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sales_amount(quantity, unit_price, discount) -> Column:
    """round(quantity * unit_price * (1 - discount), 2), exact decimal."""
    return F.round(_c(quantity).cast("decimal(10,0)") * _c(unit_price).cast(MONEY)
                   * (F.lit(1).cast("decimal(3,0)") - _c(discount).cast(RATE)), 2).cast(MONEY)


def line_profit(sales, quantity, unit_cost) -> Column:
    """round(sales_amount - quantity * unit_cost, 2), exact decimal."""
    return F.round(_c(sales).cast(MONEY)
                   - _c(quantity).cast("decimal(10,0)") * _c(unit_cost).cast(UNIT_COST), 2).cast(MONEY)


def ship_date(order_date, lag_days) -> Column:
    """Order date plus a lag in days, as ISO text; the order date as it is where
    it cannot be read as a date or the lag is NULL."""
    text = _c(order_date).cast("string")
    return F.coalesce(F.date_add(F.try_to_date(text), _c(lag_days).cast("int")).cast("string"), text)


def ship_lag_days(order_date, ship) -> Column:
    """Inverse of ``ship_date``: days between order and shipment."""
    return F.datediff(_c(ship), _c(order_date)).cast("int")


# Fixed value: order id text format (prefix and zero padding).
ORDER_LABEL_FORMAT = "ORD-%06d"


def order_label(order_number) -> Column:
    """Order id text ``ORD-`` + number zero-padded to six digits."""
    return F.format_string(ORDER_LABEL_FORMAT, _c(order_number).cast("long"))


def manual_order_id(ts) -> Column:
    """Order id of a manual sale: ``ORD`` + epoch seconds of the entry time.
    Two entries in the same second share an id, as in the source system."""
    return F.concat(F.lit("ORD"), F.unix_timestamp(_c(ts)).cast("string"))


# Fixed values of the manual-entry form: retail markup on cost and the
# default margin slider position (percent).
MANUAL_MARKUP = "1.5"
MANUAL_DEFAULT_MARGIN = 40


def manual_unit_price(unit_cost) -> Column:
    return F.round(_c(unit_cost).cast(UNIT_COST) * F.lit(MANUAL_MARKUP).cast("decimal(2,1)"), 2).cast(MONEY)


def manual_revenue(quantity, unit_price) -> Column:
    return (_c(quantity).cast("decimal(10,0)") * _c(unit_price).cast(MONEY)).cast(MONEY)


def manual_profit(revenue, margin_pct) -> Column:
    return F.round(_c(revenue).cast(MONEY) * _c(margin_pct).cast("decimal(5,0)")
                   / F.lit(100).cast("decimal(5,0)"), 2).cast(MONEY)
