"""Standard scores and moments of a rolled-up series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendtide.functions.numbers import zscore_over


def zscore(
    df: DataFrame, keys: Sequence[str], out: str, value: str = "USD", order: str | None = None
) -> DataFrame:
    """Add the standard score of ``value`` within ``keys``.

    A rolled-up series has one row per period and key, so a window partition is
    as long as the calendar, not as the fact. Along ``order``, a column that tells the
    rows of a key apart, the score does not depend on how the rows were dealt out.
    """
    window = Window.partitionBy(*keys)
    if order is not None:
        window = window.orderBy(order).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
    return df.withColumn(out, zscore_over(F.col(value), window))


def moments(df: DataFrame, keys: Sequence[str], prefix: str, value: str = "USD") -> DataFrame:
    """Smallest, largest and mean ``value`` per key."""
    return df.groupBy(*keys).agg(
        F.min(value).alias(f"{prefix}_usd_min"),
        F.max(value).alias(f"{prefix}_usd_max"),
        F.avg(value).alias(f"{prefix}_usd_mean"),
    )
