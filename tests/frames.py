"""Small frames for the tests and plain pandas versions of the series rules."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendtide.sources.adapters import as_costs

DAY0 = date(2024, 1, 1)


def costs(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Fact rows from (service, tag, day, usd); an int day counts from 2024-01-01."""
    fixed = [
        (s, t, DAY0 + timedelta(days=d) if isinstance(d, int) else d, None if u is None else float(u))
        for s, t, d, u in rows
    ]
    raw = spark.createDataFrame(fixed, "s string, t string, d date, u double")
    return as_costs(raw, F.col("s"), F.col("t"), F.col("d"), F.col("u"))


def series(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(service, day, usd) as a daily series."""
    fixed = [
        (s, DAY0 + timedelta(days=d) if isinstance(d, int) else d, float(u)) for s, d, u in rows
    ]
    return spark.createDataFrame(fixed, "SERVICE string, STARTDATE date, USD double")


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted(
        (tuple(r) for r in df.select(*columns).collect()),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def pandas_gap_fill(day: pd.DataFrame) -> pd.DataFrame:
    """One zero row for each day without any data, under the last service before it."""
    day = day.sort_values(["STARTDATE", "SERVICE"])
    out, last = [], None
    for d in pd.date_range(day.STARTDATE.min(), day.STARTDATE.max()):
        here = day[day.STARTDATE == d]
        if len(here):
            out += list(here[["SERVICE", "STARTDATE", "USD"]].itertuples(index=False, name=None))
            last = here.SERVICE.iloc[-1]
        else:
            out.append((last, d, 0.0))
    return pd.DataFrame(out, columns=["SERVICE", "STARTDATE", "USD"])


def pandas_trend(day: pd.DataFrame, scope: str = "global") -> pd.DataFrame:
    """Means, MACD, signal and crossings of a series in (day, service) order."""
    def mean(x, span):
        return x.ewm(span=span, adjust=False).mean()

    t = day.sort_values(["STARTDATE", "SERVICE"]).reset_index(drop=True)
    by_service = t.groupby("SERVICE")["USD"]
    t["fast"] = by_service.transform(lambda x: mean(x, 12))
    t["slow"] = by_service.transform(lambda x: mean(x, 26))
    t["macd"] = t.slow - t.fast
    t["signal"] = (
        mean(t.macd, 9) if scope == "global"
        else t.groupby("SERVICE")["macd"].transform(lambda x: mean(x, 9))
    )
    before = t.groupby("SERVICE")[["macd", "signal"]].shift(1)
    down = (before.macd >= before.signal) & (t.macd < t.signal)
    up = (before.macd <= before.signal) & (t.macd > t.signal)
    t["flag"] = np.where(down, -1, np.where(up, 1, 0))
    return t
