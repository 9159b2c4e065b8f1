import random
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import DAY0, pandas_gap_fill, pandas_trend, rows, series
from spendtide.operators.ewm import block_length, ewm, ewm_along
from spendtide.operators.gapfill import gap_fill
from spendtide.operators.numbering import AT, dealt, number_rows, numbered
from spendtide.operators.trend import (
    FAST, MACD, SIGNAL, SLOW, cross_flag, detect_crossings, macd, trend_lines, trend_series,
)

from spendtide.plans.materialize import materialize


def _random_rows(services: int, days: int, seed: int, missing: float = 0.0) -> list[tuple]:
    rnd = random.Random(seed)
    return [
        (f"s{s}", d, rnd.gauss(100, 40))
        for s in range(services) for d in range(days) if rnd.random() >= missing
    ]


def _pandas(raw: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(raw, columns=["SERVICE", "d", "USD"])
    df["STARTDATE"] = pd.to_datetime(DAY0) + pd.to_timedelta(df.d, unit="D")
    return df.drop(columns="d")


def _sorted(df) -> pd.DataFrame:
    out = df.toPandas()
    out["STARTDATE"] = pd.to_datetime(out["STARTDATE"])
    return out.sort_values(["STARTDATE", "SERVICE"]).reset_index(drop=True)


@pytest.mark.parametrize("span,days", [(12, 366), (2, 400), (9, 10_000)])
def test_ewm_matches_pandas_with_and_without_blocks(spark, span, days):
    raw = _random_rows(2, days, seed=span)
    got = _sorted(ewm(series(spark, raw), "USD", {"y": span}, ["SERVICE"], "STARTDATE"))
    want = _pandas(raw).sort_values(["STARTDATE", "SERVICE"]).groupby("SERVICE")["USD"].transform(
        lambda x: x.ewm(span=span, adjust=False).mean()
    )
    np.testing.assert_allclose(got.y, want, rtol=1e-12, atol=1e-11)
    assert (days > block_length(span)) == (span in (2, 9))


def test_mean_across_many_services_matches_one_pandas_pass(spark):
    raw = _random_rows(400, 40, seed=5, missing=0.2)
    placed = number_rows(series(spark, raw), ["STARTDATE", "SERVICE"], "n")
    got = _sorted(ewm_along(placed, "USD", 9, "y", "n"))
    assert list(got.n) == list(range(len(got)))
    want = _pandas(raw).sort_values(["STARTDATE", "SERVICE"]).USD.ewm(span=9, adjust=False).mean()
    assert len(got) > 2 * block_length(9)
    np.testing.assert_allclose(got.y, want, rtol=1e-12, atol=1e-11)


@pytest.mark.parametrize("scope", ["global", "service"])
def test_trend_matches_pandas(spark, scope):
    raw = _random_rows(4, 150, seed=11, missing=0.6)
    filled = gap_fill(series(spark, raw))
    got = _sorted(trend_series(trend_lines(filled, signal_scope=scope)))
    want = pandas_trend(pandas_gap_fill(_pandas(raw)), scope)
    for ours, theirs in ((FAST, "fast"), (SLOW, "slow"), (MACD, "macd"), (SIGNAL, "signal")):
        np.testing.assert_allclose(got[ours], want[theirs], rtol=1e-11, atol=1e-10)
    assert list(got.crossFlag) == list(want.flag)
    assert {-1, 0, 1} == set(got.crossFlag)


def test_resting_series_has_no_noise_crossings(spark):
    flat = [("flat", d, 3.29) for d in range(400)]
    settled = [("settled", d, 1000.01 if d > 20 else 1000.0) for d in range(400)]
    lines = trend_lines(series(spark, flat + settled), signal_scope="service")
    assert lines.where(f"SERVICE = 'flat' AND ({MACD} <> 0 OR {SIGNAL} <> 0)").count() == 0
    crossed = rows(cross_flag(lines).where("crossFlag <> 0"), "SERVICE", "STARTDATE")
    assert all(s == "settled" and d < DAY0 + timedelta(days=120) for s, d in crossed)


def test_cross_flag_rules(spark):
    lines = [  # (macd, signal): first row, fall, rise, tie, fall from a tie, stay
        (1.0, 1.0), (0.0, 0.5), (1.0, 0.5), (0.5, 0.5), (0.2, 0.5), (0.1, 0.5),
    ]
    df = spark.createDataFrame(
        [("a", DAY0 + timedelta(days=i), m, s) for i, (m, s) in enumerate(lines)],
        f"SERVICE string, STARTDATE date, {MACD} double, {SIGNAL} double",
    )
    assert [f for _, f in rows(cross_flag(df), "STARTDATE", "crossFlag")] == [0, -1, 1, 0, -1, 0]


def test_macd_sign(spark):
    rising = series(spark, [("a", d, d) for d in range(30)])
    last = DAY0 + timedelta(days=29)
    usual = macd(rising, sign="standard").where(f"STARTDATE = '{last}'").first()[MACD]
    ours = macd(rising).where(f"STARTDATE = '{last}'").first()[MACD]
    assert usual > 0 and ours == -usual


def test_detect_crossings_looks_at_one_day(spark):
    raw = _random_rows(3, 80, seed=3)
    frame = trend_series(trend_lines(series(spark, raw)))
    day = frame.where("crossFlag <> 0").agg({"date": "max"}).first()[0]
    found = detect_crossings(frame, day).collect()
    assert found and all(r.date == day and r.crossFlag != 0 for r in found)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40), st.sampled_from([2, 9, 26]))
def test_mean_stays_between_extremes(spark, values, span):
    df = ewm(
        series(spark, [("a", i, v) for i, v in enumerate(values)]),
        "USD", {"y": span}, ["SERVICE"], "STARTDATE",
    )
    slack = 1e-9 * max(1.0, max(map(abs, values)))
    got = [r.y for r in df.collect()]
    assert min(values) - slack <= min(got) and max(got) <= max(values) + slack


def test_sparse_series_carries_through_short_blocks(spark):
    """A row every 400 days: blocks of the calendar hold a handful of rows each."""
    raw = [("a", d, float(d % 7)) for d in range(0, 30_000, 400)] + [("b", 3, 1.0), ("b", 29_999, 5.0)]
    got = _sorted(ewm(series(spark, raw), "USD", {"y": 9, "z": 26}, ["SERVICE"], "STARTDATE"))
    by_service = _pandas(raw).sort_values(["STARTDATE", "SERVICE"]).groupby("SERVICE")["USD"]
    for out, span in (("y", 9), ("z", 26)):
        want = by_service.transform(lambda x, s=span: x.ewm(span=s, adjust=False).mean())
        np.testing.assert_allclose(got[out], want, rtol=1e-12, atol=1e-11)


def test_a_day_of_very_many_services_is_spread(spark):
    """No task numbers a whole day: a million services of one day in ranges of even size."""
    day = spark.range(1_000_000, numPartitions=8).select(
        F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("SERVICE"),
        F.lit(DAY0).alias("STARTDATE"), F.col("id").cast("double").alias("USD"),
    )
    stored = materialize(dealt(day, ["STARTDATE", "SERVICE"]), "dealt")
    sizes = [r["count"] for r in stored.groupBy(F.shiftright(AT, 33)).count().collect()]
    assert sum(sizes) == 1_000_000 and len(sizes) >= 4 and max(sizes) < 400_000
    assert numbered(stored, "n").where("n <> USD").count() == 0


def test_numbers_of_any_order(spark):
    frame = spark.range(1000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    found = number_rows(frame.where("b > 3"), [F.desc("a"), "b"], "n").collect()
    want = sorted(((k % 7, k) for k in range(4, 1000)), key=lambda r: (-r[0], r[1]))
    assert [(r.a, r.b) for r in sorted(found, key=lambda r: r.n)] == want
    assert sorted(r.n for r in found) == list(range(996))
    assert number_rows(frame.limit(0), ["a", "b"], "n").collect() == []
