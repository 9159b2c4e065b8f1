"""Removal of alerts on negligible spend."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def low_value_keys(
    costs: DataFrame,
    as_of: date,
    floor: float = 0.01,
    keys: Sequence[str] = ("SERVICE", "TAG"),
    on: str = "row",
) -> DataFrame:
    """Keys with an amount below ``floor`` on ``as_of`` (credits are below it too).

    ``row`` looks at single rows, which ``daily_cube`` keeps as USD_MIN;
    ``service_total`` at the sum per key.
    """
    that_day = costs.where(F.col("STARTDATE") == F.lit(as_of))
    if on == "row":
        smallest = "USD_MIN" if "USD_MIN" in costs.columns else "USD"
        return that_day.where(F.col(smallest) < F.lit(float(floor))).select(*keys).distinct()
    return (
        that_day.groupBy(*keys)
        .agg(F.sum("USD").alias("USD"))
        .where(F.col("USD") < F.lit(float(floor)))
        .select(*keys)
    )


def anti_suppress(alerts: DataFrame, low: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Alerts whose keys are not in ``low``; NULL keys match each other."""
    low = low.select([F.col(k).alias(f"low_{k}") for k in keys])
    same = reduce(
        lambda a, b: a & b, [alerts[k].eqNullSafe(low[f"low_{k}"]) for k in keys]
    )
    return alerts.join(low, same, "left_anti")


def tagged(alerts: DataFrame, drop_empty: bool = False) -> DataFrame:
    """Alerts with a tag; the empty tag counts as one unless ``drop_empty``."""
    kept = alerts.where(F.col("TAG").isNotNull())
    return kept.where(F.col("TAG") != "") if drop_empty else kept
