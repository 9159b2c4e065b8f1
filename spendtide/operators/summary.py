"""Spend of the current month."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendtide.functions.dates import add_date_parts, date_key, in_month, lookback_window
from spendtide.functions.numbers import round2, total


@dataclass(frozen=True)
class Summary:
    total_by_service: DataFrame
    daily_by_service: DataFrame


def daily_spend(costs: DataFrame) -> DataFrame:
    """Rounded spend per service and day, with date parts and key."""
    sums = costs.groupBy("SERVICE", "STARTDATE").agg(
        round2(F.sum("USD").cast("double")).alias("TOTAL_SPEND")
    )
    return add_date_parts(sums).select(
        "SERVICE", "STARTDATE", "DAY", "MONTH", "YEAR", "TOTAL_SPEND",
        date_key(F.col("STARTDATE")).alias("DATE_STR"),
    )


def month_to_date(daily: DataFrame, month_of: date) -> DataFrame:
    return daily.where(in_month(F.col("STARTDATE"), month_of))


def mtd_by_service(daily: DataFrame) -> DataFrame:
    """Sum of the rounded daily spend per service."""
    return _named(daily).groupBy("SERVICE").agg(total("TOTAL_SPEND").alias("TOTAL_SPEND"))


def daily_by_service(daily: DataFrame) -> DataFrame:
    """Sum of the rounded daily spend per day and service."""
    return (
        _named(daily)
        .groupBy("DATE_STR", "SERVICE")
        .agg(total("TOTAL_SPEND").alias("TOTAL_SPEND"))
    )


def _named(daily: DataFrame) -> DataFrame:
    return daily.where(F.col("SERVICE").isNotNull())


def summarize(costs: DataFrame, as_of: date, month_of: date, lookback_months: int = 12) -> Summary:
    """Both summaries of the month of ``month_of`` within the trailing window.

    The month filter is on a grouping key, so it joins the window's predicate
    below the aggregation and in the scan.
    """
    daily = month_to_date(
        daily_spend(lookback_window(costs, as_of, lookback_months)), month_of
    )
    return Summary(mtd_by_service(daily), daily_by_service(daily))
