"""Sums by service or service and tag, per day or per week."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendtide.functions.dates import year_week
from spendtide.functions.numbers import total

LEVELS = {"svc": ("SERVICE",), "svc_tag": ("SERVICE", "TAG")}
PERIODS = {"day": "STARTDATE", "week": "yearWK"}


def daily_cube(costs: DataFrame) -> DataFrame:
    """One row per (SERVICE, TAG, STARTDATE): the sum and the smallest row amount.

    Every rollup, summary and suppression rule can be derived from it, so a run
    reads and shuffles the fact once. Sums combine map-side, so a key that holds
    much of the table reaches its reducer as one row per map task. Untagged (NULL)
    rows are kept: service totals include them. Exact amounts have exact sums here.
    """
    return (
        costs.where(F.col("SERVICE").isNotNull())
        .groupBy("SERVICE", "TAG", "STARTDATE")
        .agg(total("USD").alias("USD"), F.min("USD").alias("USD_MIN"))
    )


def rollup(
    costs: DataFrame, level: str = "svc", grain: str = "day", iso_year: bool = False
) -> DataFrame:
    """Spend per key and period, from the fact or from ``daily_cube``.

    Rows with a NULL key are left out of that level.
    """
    keys, period = LEVELS[level], PERIODS[grain]
    keyed = costs.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    if grain == "week":
        keyed = keyed.withColumn(period, year_week(F.col("STARTDATE"), iso_year))
    # Exact amounts are summed as such; only the sum becomes a double.
    return keyed.groupBy(*keys, period).agg(total("USD").cast("double").alias("USD"))
