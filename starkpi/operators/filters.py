"""Dashboard filters.

A ``SalesFilter`` folds optional predicates into one Column; an empty
category or country list means "no filter", not "no rows".  Predicates are
plain column comparisons on the star's own columns, so Catalyst pushes the
date range into the Parquet scan and, on a month-partitioned fact, the
``order_month`` predicate added by ``month_predicate`` prunes partitions.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_date(d) -> _dt.date | None:
    if d is None or isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))


@dataclass(frozen=True)
class SalesFilter:
    start: _dt.date | str | None = None
    end: _dt.date | str | None = None
    categories: tuple[str, ...] = field(default_factory=tuple)
    countries: tuple[str, ...] = field(default_factory=tuple)

    def __post_init__(self):
        object.__setattr__(self, "start", _as_date(self.start))
        object.__setattr__(self, "end", _as_date(self.end))
        object.__setattr__(self, "categories", tuple(self.categories or ()))
        object.__setattr__(self, "countries", tuple(self.countries or ()))

    # Inclusive date range on order_date (a DateType column)
    def date_predicate(self, col: str = "order_date") -> Column | None:
        c = F.col(col)
        if self.start and self.end:
            return c.between(F.lit(self.start), F.lit(self.end))
        if self.start:
            return c >= F.lit(self.start)
        if self.end:
            return c <= F.lit(self.end)
        return None

    # Optional IN lists
    def category_predicate(self, col: str = "category") -> Column | None:
        return F.col(col).isin(list(self.categories)) if self.categories else None

    def country_predicate(self, col: str = "country") -> Column | None:
        return F.col(col).isin(list(self.countries)) if self.countries else None

    def month_predicate(self, col: str = "order_month") -> Column | None:
        """Same date range on the month partition column (for pruning)."""
        if not (self.start or self.end):
            return None
        c = F.col(col)
        lo = F.lit(self.start.replace(day=1)) if self.start else None
        hi = F.lit(self.end.replace(day=1)) if self.end else None
        if lo is not None and hi is not None:
            return c.between(lo, hi)
        return c >= lo if lo is not None else c <= hi

    # Conjunction of whichever filters are set
    def predicate(self, dates: bool = True, categories: bool = True,
                  countries: bool = True) -> Column:
        parts = []
        if dates:
            parts.append(self.date_predicate())
        if categories:
            parts.append(self.category_predicate())
        if countries:
            parts.append(self.country_predicate())
        parts = [p for p in parts if p is not None]
        out = F.lit(True)
        for p in parts:
            out = out & p
        return out

    def with_dates(self, start, end) -> "SalesFilter":
        return SalesFilter(start, end, self.categories, self.countries)


# Fixed values of the dashboard's initial filter: start date, number of countries.
DEFAULT_START = _dt.date(2024, 1, 1)
DEFAULT_N_COUNTRIES = 5


def default_filter(countries: list[str], today: _dt.date | None = None,
                   default_start: _dt.date = DEFAULT_START, n_countries: int = DEFAULT_N_COUNTRIES) -> SalesFilter:
    """The dashboard's initial filter: from ``default_start`` to today,
    all categories (empty list), the first ``n_countries`` countries of the
    sorted pick list."""
    return SalesFilter(default_start, today or _dt.date.today(), (),
                       tuple(sorted(countries)[:n_countries]))


def default_filter_for(countries_df, today: _dt.date | None = None,
                       n_countries: int = DEFAULT_N_COUNTRIES, default_start: _dt.date = DEFAULT_START) -> SalesFilter:
    """P11 over a country domain DataFrame (e.g. ``explorer.distinct_countries``):
    only the first ``n_countries`` sorted names reach the driver."""
    first = [r[0] for r in countries_df.orderBy(countries_df.columns[0]).limit(n_countries).collect()]
    return default_filter(first, today=today, default_start=default_start, n_countries=n_countries)
