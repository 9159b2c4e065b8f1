"""MACD, its signal line and their crossings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendtide.functions.dates import add_date_parts
from spendtide.operators.ewm import ewm, ewm_along
from spendtide.operators.numbering import dealt, number_rows

# Output column names.
FAST, SLOW = "svc_day_usd_12ewm", "svc_day_usd_26ewm"
MACD, SIGNAL = "svc_day_usd_macd", "svc_day_usd_9ewm"
PLACE = "place"


def macd(
    svc_day: DataFrame,
    fast_span: int = 12,
    slow_span: int = 26,
    sign: str = "slow_minus_fast",
) -> DataFrame:
    """Add both means of USD and their difference, per service in date order."""
    means = ewm(svc_day, "USD", {FAST: fast_span, SLOW: slow_span}, ["SERVICE"], "STARTDATE")
    difference = F.col(SLOW) - F.col(FAST)
    return means.withColumn(MACD, difference if sign == "slow_minus_fast" else -difference)


#: The order of the signal line that runs through all services.
ORDER = ("STARTDATE", "SERVICE")


def by_place(svc_day: DataFrame) -> DataFrame:
    """The series in (date, service) order, to be stored and then ``numbered``."""
    return dealt(svc_day, ORDER)


def with_place(svc_day: DataFrame) -> DataFrame:
    """Add the row's place in (date, service) order, which stores the series once; a day
    with very many services is spread like any other rows."""
    return number_rows(svc_day, ORDER, PLACE)


def signal(df: DataFrame, span: int = 9, scope: str = "global") -> DataFrame:
    """Add the mean of the MACD.

    ``global`` runs one mean through all services in (date, service) order;
    ``service`` restarts it for each service.
    """
    if scope == "service":
        return ewm(df, MACD, {SIGNAL: span}, ["SERVICE"], "STARTDATE")
    placed = df if PLACE in df.columns else with_place(df)
    return ewm_along(placed, MACD, span, SIGNAL, PLACE).drop(PLACE)


def cross_flag(df: DataFrame) -> DataFrame:
    """Add -1 where the MACD falls below the signal, 1 where it rises above, else 0."""
    series = Window.partitionBy("SERVICE").orderBy("STARTDATE")
    line, base = F.col(MACD), F.col(SIGNAL)
    line_before, base_before = F.lag(MACD).over(series), F.lag(SIGNAL).over(series)
    flag = (
        F.when((line_before >= base_before) & (line < base), -1)
        .when((line_before <= base_before) & (line > base), 1)
        .otherwise(0)
    )
    return df.withColumn("crossFlag", flag)


def trend_lines(
    svc_day: DataFrame,
    fast_span: int = 12,
    slow_span: int = 26,
    signal_span: int = 9,
    signal_scope: str = "global",
    macd_sign: str = "slow_minus_fast",
) -> DataFrame:
    """Add means, MACD and signal to a (SERVICE, STARTDATE, USD) series, which may have
    its places already."""
    if signal_scope == "global" and PLACE not in svc_day.columns:
        # Places are counted on the bare series, not on the result of the means.
        svc_day = with_place(svc_day)
    lines = macd(svc_day, fast_span, slow_span, macd_sign)
    return signal(lines, signal_span, signal_scope)


def trend_series(lines: DataFrame) -> DataFrame:
    """Trend lines of every service and day with their crossing flag."""
    return add_date_parts(cross_flag(lines)).select(
        "STARTDATE", "SERVICE", "YEAR", "MONTH", "DAY",
        FAST, SLOW, MACD, SIGNAL, F.col("STARTDATE").alias("date"), "crossFlag",
    )


def detect_crossings(series: DataFrame, as_of: date) -> DataFrame:
    """Crossings on ``as_of``."""
    return series.where((F.col("date") == F.lit(as_of)) & (F.col("crossFlag") != 0))
