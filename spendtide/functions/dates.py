"""Calendar expressions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_date_parts(df: DataFrame, on: str = "STARTDATE") -> DataFrame:
    """Add DAY, ISO WEEK, MONTH and YEAR of ``on``."""
    return df.withColumns({
        "DAY": F.dayofmonth(on),
        "WEEK": F.weekofyear(on),
        "MONTH": F.month(on),
        "YEAR": F.year(on),
    })


def year_week(day: Column, iso_year: bool = False) -> Column:
    """Year * 100 + ISO week.

    The year is the calendar year, so the days around New Year can share a key
    with the far end of that year; ``iso_year`` uses the year the week is in.
    """
    year = F.extract(F.lit("YEAROFWEEK"), day) if iso_year else F.year(day)
    return (year * 100 + F.weekofyear(day)).cast("int")


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    return F.make_date(year, month, day)


def months_back(day: date, months: int) -> date:
    """The day ``months`` before, or the last one of its month."""
    years, month = divmod(day.year * 12 + day.month - 1 - months, 12)
    last = (date(years + (month == 11), (month + 1) % 12 + 1, 1) - timedelta(days=1)).day
    return date(years, month + 1, min(day.day, last))


def lookback_window(
    df: DataFrame, as_of: date, months: int = 12, on: str = "STARTDATE"
) -> DataFrame:
    """Rows from ``months`` before ``as_of`` up to ``as_of``, both included.

    The bounds fold to literals, so the predicate prunes partitions and reaches
    the parquet reader.
    """
    last = F.lit(as_of)
    return df.where(F.col(on).between(F.add_months(last, -months), last))


def in_month(day: Column, month_of: date) -> Column:
    """True within the calendar month of ``month_of``."""
    first = F.trunc(F.lit(month_of), "MM").cast("date")
    return (day >= first) & (day < F.add_months(first, 1))
