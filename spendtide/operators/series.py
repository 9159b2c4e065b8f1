"""Chart-ready series, one job for all charted services."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendtide.functions.dates import date_key
from spendtide.functions.numbers import round2
from spendtide.functions.text import (
    DAILY_CHART, MONTH_CHART, SPIKE_PREFIX, TREND_PREFIX, chart_key, chart_name, chart_title,
)
from spendtide.operators.summary import Summary
from spendtide.operators.trend import MACD, SIGNAL

# Titles of the summary charts.
MONTH_TITLE, DAILY_TITLE = "Month to Date Spend by Service", "Daily Spend x Service"


def of_alerted(series: DataFrame, alerts: DataFrame) -> DataFrame:
    """Rows of the services that have an alert, with the charts' names for them."""
    alerted = alerts.select("SERVICE").distinct()
    return series.join(alerted.withColumn("_key", chart_key(F.col("SERVICE"))), "SERVICE")


def macd_series(
    trend: DataFrame,
    alerts: DataFrame,
    as_of: date,
    region: Column | None = None,
    title: str | None = None,
) -> DataFrame:
    """Rounded MACD and signal lines of every service with a trend alert."""
    return of_alerted(trend, alerts).select(
        chart_name(TREND_PREFIX, F.col("_key"), as_of).alias("chart_id"),
        chart_title(F.col("SERVICE"), region, title).alias("chart_title"),
        date_key(F.col("date")).alias("DATE"),
        round2(F.col(MACD)).alias("MACD"),
        round2(F.col(SIGNAL)).alias("9EWM"),
    )


def spike_series(
    svc_day: DataFrame,
    alerts: DataFrame,
    as_of: date,
    z_in: float = 1.0,
    last_rows: int | None = None,
    region: Column | None = None,
    title: str | None = None,
) -> DataFrame:
    """Bars of every service with a spike alert, all of them or the ``last_rows`` latest;
    ``left_out`` is the number of a service's rows that are not charted.

    Mean and threshold are those of the charted, rounded bars, and a bar is red
    strictly above the threshold, so the colours can differ from the alerts.
    """
    latest_first = Window.partitionBy("SERVICE").orderBy(F.desc("STARTDATE"))
    charted = Window.partitionBy("SERVICE")
    bars = of_alerted(svc_day, alerts)
    if last_rows is None:
        bars = bars.withColumn("left_out", F.lit(0))
    else:
        bars = (
            bars.withColumn("_n", F.row_number().over(latest_first))
            .withColumn("left_out", F.greatest(F.lit(0), F.max("_n").over(charted) - last_rows))
            .where(F.col("_n") <= last_rows)
        )
    bars = (
        bars.withColumn("USD", round2(F.col("USD")))
        .withColumn("mean_line", F.avg("USD").over(charted))
        .withColumn(
            "threshold_line",
            F.col("mean_line") + F.stddev_samp("USD").over(charted) * float(z_in),
        )
    )
    return bars.select(
        chart_name(SPIKE_PREFIX, F.col("_key"), as_of).alias("chart_id"),
        chart_title(F.col("SERVICE"), region, title).alias("chart_title"),
        date_key(F.col("STARTDATE")).alias("DATE"),
        "USD",
        "mean_line",
        "threshold_line",
        F.when(F.col("USD") > F.col("threshold_line"), "red").otherwise("blue").alias("colour"),
        "left_out",
    )


def summary_series(summary: Summary, as_of: date) -> DataFrame:
    """Bars of both summary charts; the month-to-date chart has no date."""
    stamp = f"_{as_of:%Y%m%d}"
    spend = round2(F.col("TOTAL_SPEND")).alias("TOTAL_SPEND")
    month = summary.total_by_service.select(
        F.lit(MONTH_CHART + stamp).alias("chart_id"),
        F.lit(MONTH_TITLE).alias("chart_title"),
        F.lit(None).cast("date").alias("DATE"),
        "SERVICE",
        spend,
    )
    daily = summary.daily_by_service.select(
        F.lit(DAILY_CHART + stamp).alias("chart_id"),
        F.lit(DAILY_TITLE).alias("chart_title"),
        F.to_date("DATE_STR", "yyyyMMdd").alias("DATE"),
        "SERVICE",
        spend,
    )
    return month.unionByName(daily)
