"""Money and ratio rules, used by every query and mirrored by the SQL oracle.

Rule 1 (sums): money is ``decimal(18,2)`` per line; sums are exact decimal
sums and are cast to double only at the output edge, so a distributed sum
cannot flip a rounded cent.

Rule 2 (ratios and averages): a ratio is computed in double, pinned to six
decimals, then rounded half-up to the requested scale:
``cast(round(cast(num/den as decimal(20,6)), scale) as double)``.
Division by zero yields NULL (``try_divide``) instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
UNIT_COST = DecimalType(10, 2)
RATE = DecimalType(4, 2)
_PINNED = DecimalType(20, 6)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x) -> Column:
    """Exact money value (two decimals) from any numeric column."""
    return _c(x).cast(MONEY)


def money_out(x) -> Column:
    """Money at the output edge: exact value rounded to cents, as double."""
    return F.round(_c(x), 2).cast("double")


def ratio(num, den, scale: int = 2, mult: float | None = None) -> Column:
    """Rounded ratio per Rule 2; NULL when ``den`` is 0 or NULL."""
    q = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    if mult is not None:
        q = q * F.lit(float(mult))
    return F.round(q.cast(_PINNED), scale).cast("double")


def pct(num, den, scale: int = 2) -> Column:
    """Percentage ``num / den * 100`` rounded per Rule 2."""
    return ratio(num, den, scale, mult=100.0)


def gain_pct(before, after, scale: int = 1) -> Column:
    """Percentage gain ``(before - after) / before * 100`` (0 when before <= 0)."""
    b, a = _c(before).cast("double"), _c(after).cast("double")
    return F.when(b > 0, pct(b - a, b, scale)).otherwise(F.lit(0.0))


# --- SQL mirrors (used by the DuckDB oracle strings) -----------------------

def sql_ratio(num: str, den: str, scale: int = 2, mult: float | None = None) -> str:
    q = f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"
    if mult is not None:
        q = f"({q} * {float(mult)})"
    return f"CAST(ROUND(CAST({q} AS DECIMAL(20,6)), {scale}) AS DOUBLE)"


def sql_pct(num: str, den: str, scale: int = 2) -> str:
    return sql_ratio(num, den, scale, mult=100.0)


def sql_money_out(x: str) -> str:
    return f"CAST(ROUND({x}, 2) AS DOUBLE)"
