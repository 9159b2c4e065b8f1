"""Rows for calendar days without spend."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def calendar_days(df: DataFrame) -> DataFrame:
    """Every day from the first to the last STARTDATE."""
    span = df.agg(F.min("STARTDATE").alias("first"), F.max("STARTDATE").alias("last"))
    return span.select(F.explode(F.sequence("first", "last")).alias("STARTDATE"))


def gap_fill(svc_day: DataFrame, mode: str = "global") -> DataFrame:
    """Complete a (SERVICE, STARTDATE, USD) series with zero-spend days.

    ``global`` adds one row for each day on which no service has data, under the
    alphabetically last service of the latest earlier day that has. ``per_service``
    gives every service every day between the overall first and last one.
    """
    if mode == "none":
        return svc_day
    if mode == "per_service":
        return _fill_each_service(svc_day)
    return svc_day.unionByName(_global_fillers(svc_day))


def _global_fillers(svc_day: DataFrame) -> DataFrame:
    # One row per calendar day, so the unpartitioned window is bounded by the
    # length of the calendar (366 rows a year), whatever the fact's size.
    # Taking USD along keeps this branch's input equal to the unfilled series, so
    # that both sides of the union read one exchange and the fact is scanned once.
    per_day = svc_day.groupBy("STARTDATE").agg(
        F.max(F.struct("SERVICE", "USD"))["SERVICE"].alias("SERVICE")
    )
    following = F.lead("STARTDATE").over(Window.orderBy("STARTDATE"))
    return (
        per_day.withColumn("next_day", following)
        .where(F.col("next_day") > F.date_add("STARTDATE", 1))
        .select(
            "SERVICE",
            F.explode(
                F.sequence(F.date_add("STARTDATE", 1), F.date_sub("next_day", 1))
            ).alias("STARTDATE"),
            F.lit(0.0).alias("USD"),
        )
    )


def _fill_each_service(svc_day: DataFrame) -> DataFrame:
    # Each row covers the days up to the service's next row (the first one also
    # those before it), which takes the partitioning later windows need anyway
    # and no join with the calendar.
    first_day = svc_day.select(F.min("STARTDATE")).scalar()
    last_day = svc_day.select(F.max("STARTDATE")).scalar()
    series = Window.partitionBy("SERVICE").orderBy("STARTDATE")
    covered = svc_day.withColumns({
        "from_day": F.when(F.lag("STARTDATE").over(series).isNull(), first_day)
        .otherwise(F.col("STARTDATE")),
        "to_day": F.coalesce(F.date_sub(F.lead("STARTDATE").over(series), 1), last_day),
    })
    return covered.select(
        "SERVICE",
        F.col("STARTDATE").alias("own_day"),
        "USD",
        F.explode(F.sequence("from_day", "to_day")).alias("STARTDATE"),
    ).select(
        "SERVICE",
        "STARTDATE",
        F.when(F.col("STARTDATE") == F.col("own_day"), F.col("USD")).otherwise(0.0).alias("USD"),
    )
