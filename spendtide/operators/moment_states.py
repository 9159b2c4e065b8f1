"""Moments as states that are kept and merged, instead of recomputed from all rows.

A state is what a stretch of a key's series amounts to: how many values, their mean, the sum
of their squared distances from it, the smallest and the largest. States of disjoint
stretches merge to the state of their union, in any order, so those of past months can be
stored and only the months that changed are made again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendtide.functions.numbers import without_nan

STATE = ("n", "mean", "squares", "low", "high")


def value_states(series: DataFrame, keys: Sequence[str], value: str = "USD") -> DataFrame:
    """Every value as the state of itself."""
    x = F.col(value)
    return series.select(
        *keys, F.lit(1).cast("long").alias("n"), x.alias("mean"), F.lit(0.0).alias("squares"),
        x.alias("low"), x.alias("high"),
    )


def merged_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state per key.

    The mean comes first, then each state's own spread and its distance from that mean: no
    difference of large sums, so nothing cancels. A key has one state per stretch, not per
    row, so its window is as short as the number of stretches.
    """
    own = Window.partitionBy(*keys)
    mean = F.sum(F.col("n") * F.col("mean")).over(own) / F.sum("n").over(own)
    off = F.col("mean") - F.col("_mean")
    return states.withColumn("_mean", mean).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.first("_mean").alias("mean"),
        F.sum(F.col("squares") + F.col("n") * off * off).alias("squares"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )


def states_of(
    series: DataFrame, keys: Sequence[str], period: Column, name: str, value: str = "USD"
) -> DataFrame:
    """One state per key and period of a series that has one value per key and day."""
    own = [*keys, name]
    return merged_states(value_states(series.withColumn(name, period), own, value), own)


def moments_of(states: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Smallest, largest and mean value per key, from one state per key."""
    return states.select(
        *keys, F.col("low").alias(f"{prefix}_usd_min"), F.col("high").alias(f"{prefix}_usd_max"),
        F.col("mean").alias(f"{prefix}_usd_mean"),
    )


def score_by(states: DataFrame, series: DataFrame, keys: Sequence[str], out: str, value: str = "USD") -> DataFrame:
    """The standard score of the rows of ``series`` by the states of their keys, NULL where
    the state is of one value or of equal ones."""
    spread = F.sqrt(F.col("squares") / F.nullif(F.col("n") - 1, F.lit(0)))
    score = without_nan((F.col(value) - F.col("mean")) / F.nullif(spread, F.lit(0.0)))
    return series.join(states, list(keys)).withColumn(
        out, F.when(F.col("high") > F.col("low"), score)
    ).drop(*STATE)
