"""Other tables in the shape of the cost fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendtide.functions.dates import add_date_parts
from spendtide.functions.numbers import without_nan
from spendtide.schema import COST_FACT, COST_METRIC


def as_costs(df: DataFrame, service: Column, tag: Column, day: Column, usd: Column) -> DataFrame:
    """Cost fact rows from four expressions; the other columns follow from them."""
    costs = df.select(
        service.cast("string").alias("SERVICE"),
        tag.cast("string").alias("TAG"),
        F.lit(COST_METRIC).alias("METRIC"),
        F.lit("DAILY").alias("GRANULARITY"),
        F.to_date(day).alias("STARTDATE"),
        F.date_add(F.to_date(day), 1).alias("ENDDATE"),
        without_nan(usd.cast("double")).alias("USD"),
        F.lit("USD").alias("UNIT"),
    )
    return add_date_parts(costs).select(*COST_FACT.names)


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def orders_as_costs(spark: SparkSession, folder: str) -> DataFrame:
    return as_costs(
        _read(spark, folder, "orders"),
        F.col("o_orderpriority"), F.col("o_orderstatus"),
        F.col("o_orderdate"), F.col("o_totalprice"),
    )


def events_as_costs(spark: SparkSession, folder: str) -> DataFrame:
    return as_costs(
        _read(spark, folder, "events"),
        F.col("event_type"), F.col("user_id"), F.col("ts"), F.col("value"),
    )


def lineitem_as_costs(spark: SparkSession, folder: str) -> DataFrame:
    return as_costs(
        _read(spark, folder, "lineitem"),
        F.col("l_returnflag"), F.col("l_linestatus"),
        F.col("l_shipdate"), F.col("l_extendedprice"),
    )
