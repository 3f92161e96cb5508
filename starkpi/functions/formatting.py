"""Display formats (F15), run stamps (F18) and log-line parsing (F16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def currency(x, decimals: int = 2) -> Column:
    """``$1,234.56`` (or ``$1,234`` with decimals=0); the dollar sign goes in
    front of the signed number (``$-98``), as the source dashboards print it."""
    return F.concat(F.lit("$"), F.format_number(_c(x).cast("double"), decimals))


def number(x, decimals: int = 0) -> Column:
    """Thousands-separated number ``1,234``."""
    return F.format_number(_c(x).cast("double"), decimals)


def percent(x, decimals: int = 1) -> Column:
    """``41.7%`` (no thousands separator; half-even rounding like the
    source system's number formatting)."""
    return F.concat(F.regexp_replace(F.format_number(_c(x).cast("double"), decimals), ",", ""), F.lit("%"))


def day_stamp(ts) -> Column:
    """``YYYYMMDD`` stamp used in export file names."""
    return F.date_format(_c(ts), "yyyyMMdd")


# Labels and number pattern of the benchmark log lines.
LOG_LABEL_WITHOUT = "without indexes"
LOG_LABEL_WITH = "with indexes"
LOG_LABEL_SPEEDUP = "speedup:"
LOG_AVG_PATTERN = r"avg=([-0-9.]+)ms"
LOG_SPEEDUP_PATTERN = r":\s*([-0-9.]+)\s*%?\s*$"

