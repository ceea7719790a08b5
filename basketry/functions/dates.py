"""Date helpers. Tables hold ``DateType`` only, so no time zone enters a result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAYS_PER_MONTH = 30


# The cutoffs are computed inside the scalar subquery: a bare subquery in a filter is
# replaced by its value at run time and reaches the Parquet reader, which then skips
# row groups; an expression around it would not.


def days_cutoff(df: DataFrame, months: int, date_col: str) -> Column:
    """Latest date minus ``months`` blocks of thirty days."""
    return df.agg(F.date_sub(F.max(date_col), months * DAYS_PER_MONTH)).scalar()


def calendar_cutoff(df: DataFrame, months: int, date_col: str) -> Column:
    """Latest date minus ``months`` calendar months, clamped at the month's end."""
    return df.agg(F.add_months(F.max(date_col), -months)).scalar()


def month_start(col: Column | str) -> Column:
    return F.trunc(col, "MM")


def months_inclusive(first: Column, last: Column) -> Column:
    """Number of calendar months touched between two dates, one at least."""
    span = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first) + 1
    return F.greatest(F.lit(1), span)


def week_year(col: Column | str) -> Column:
    """Year the ISO week belongs to."""
    day = F.col(col) if isinstance(col, str) else col
    # The Thursday of the week decides the ISO year.
    return F.year(F.date_add(day, F.lit(3) - F.weekday(day)))
