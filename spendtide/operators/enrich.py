"""The fact with every score, moment and trend line of its keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from spendtide.functions.dates import year_week
from spendtide.functions.numbers import zscore_over
from spendtide.operators.rollups import rollup

KEYS = ("SERVICE", "TAG", "STARTDATE")


def _with_stats(
    df: DataFrame, value: str, window: WindowSpec, prefix: str, scored: str | None = None
) -> DataFrame:
    """Score and moments of ``value``; it may be NULL on rows that repeat a period,
    whose score is then that of ``scored``."""
    x = F.col(value)
    return df.withColumns({
        f"{prefix}_zscore": zscore_over(x, window, F.col(scored) if scored else None),
        f"{prefix}_usd_min": F.min(x).over(window),
        f"{prefix}_usd_max": F.max(x).over(window),
        f"{prefix}_usd_mean": F.avg(x).over(window),
    })


def _service_days(lines: DataFrame) -> DataFrame:
    """Per service and day: score, moments and trend lines."""
    days = _with_stats(lines, "USD", Window.partitionBy("SERVICE"), "svc_day")
    stats = [c for c in days.columns if c.startswith("svc_day_")]
    return days.select("SERVICE", "STARTDATE", *stats)


def _service_weeks(svc_week: DataFrame) -> DataFrame:
    """Per service and week: score and moments."""
    return _with_stats(svc_week, "USD", Window.partitionBy("SERVICE"), "svc_wk").drop("USD")


def _tag_days(cube: DataFrame) -> DataFrame:
    """Per service, tag and day: day and week scores and moments of the tag.

    The first window partitions by (SERVICE, TAG) and the others refine that, so one
    exchange serves all. A week's sum stands on each of its days; only the first of
    them enters the week statistics.
    """
    tag = Window.partitionBy("SERVICE", "TAG")
    week = Window.partitionBy("SERVICE", "TAG", "yearWK")
    first_of_week = F.row_number().over(week.orderBy("STARTDATE")) == 1
    days = _with_stats(cube, "USD", tag, "svc_tag_day")
    days = days.withColumn("week_usd", F.sum("summed").over(week).cast("double")).withColumn(
        "week_once", F.when(first_of_week, F.col("week_usd"))
    )
    days = _with_stats(days, "week_once", tag, "svc_tag_wk", scored="week_usd")
    stats = [c for c in days.columns if c.startswith("svc_tag_")]
    # Untagged rows belong to no tag series.
    return days.select(
        *KEYS, *[F.when(F.col("TAG").isNotNull(), F.col(c)).alias(c) for c in stats]
    )


def service_stats(cube: DataFrame, lines: DataFrame, iso_year: bool = False) -> DataFrame:
    """All statistics of each (SERVICE, STARTDATE).

    ``lines`` are the ``trend_lines`` of the gap-filled service series.
    """
    week = year_week(F.col("STARTDATE"), iso_year)
    weeks = _service_weeks(rollup(cube, "svc", "week", iso_year))
    days = _service_days(lines).withColumn("yearWK", week)
    return days.join(weeks, ["SERVICE", "yearWK"], "left").drop("yearWK")


def tag_stats(cube: DataFrame, iso_year: bool = False) -> DataFrame:
    """The statistics of each (SERVICE, TAG, STARTDATE) of the daily cube."""
    usd = F.col("USD")
    cube = cube.select(
        *KEYS, usd.cast("double").alias("USD"), usd.alias("summed"),
        year_week(F.col("STARTDATE"), iso_year).alias("yearWK"),
    )
    return _tag_days(cube)


def with_stats(
    fact: DataFrame, of_services: DataFrame, of_tags: DataFrame, iso_year: bool = False
) -> DataFrame:
    """Every fact row with the statistics of its service, day and tag.

    Two joins on unique keys, so no row is lost or repeated. ``of_services`` has a row
    per service and day; stored, it has a known size, by which Spark broadcasts it and
    leaves the fact unshuffled. ``of_tags`` has eight narrow columns; where it is too
    large for that, both sides are sorted and adaptive skew handling splits a key with
    very many fact rows.
    """
    left = fact.select(
        *KEYS, "DAY", "WEEK", "MONTH", "YEAR", F.col("USD").cast("double").alias("USD"),
        year_week(F.col("STARTDATE"), iso_year).alias("yearWK"),
    ).join(of_services, ["SERVICE", "STARTDATE"], "left")
    right = of_tags.withColumnsRenamed({k: f"stat_{k}" for k in KEYS})
    same = (
        (F.col("SERVICE") == F.col("stat_SERVICE"))
        & (F.col("STARTDATE") == F.col("stat_STARTDATE"))
        & F.col("TAG").eqNullSafe(F.col("stat_TAG"))
    )
    return left.join(right, same, "left").drop(*[f"stat_{k}" for k in KEYS])
