from datetime import date

import pytest
from pyspark.sql import functions as F

from frames import costs, rows, series
from spendtide.config import JobConfig
from spendtide.functions.dates import (
    add_date_parts, date_from_parts, date_key, in_month, lookback_window, year_week,
)
from spendtide.operators.gapfill import calendar_days, gap_fill

DAYS = [date(2023, 1, 1), date(2024, 2, 29), date(2024, 12, 30), date(2025, 2, 28)]


@pytest.fixture
def days(spark):
    return spark.createDataFrame([(d,) for d in DAYS], "STARTDATE date")


def test_date_parts(days):
    assert rows(add_date_parts(days), "YEAR", "MONTH", "DAY", "WEEK") == [
        (2023, 1, 1, 52), (2024, 12, 30, 1), (2024, 2, 29, 9), (2025, 2, 28, 9),
    ]


def test_year_week_uses_calendar_year_unless_told(days):
    d = F.col("STARTDATE")
    got = rows(days.select("STARTDATE", year_week(d), year_week(d, iso_year=True)), "*")
    assert [r[1:] for r in got] == [
        (202352, 202252), (202409, 202409), (202401, 202501), (202509, 202509),
    ]


def test_date_key_and_rebuilt_date(days):
    d = F.col("STARTDATE")
    got = rows(days.select(date_key(d), date_from_parts(F.year(d), F.month(d), F.day(d))), "*")
    assert got == [(f"{d:%Y%m%d}", d) for d in DAYS]


def test_lookback_is_inclusive_and_clips_leap_day(spark):
    wanted = [date(2023, 2, 28), date(2024, 2, 29)]
    outside = [date(2023, 2, 27), date(2024, 3, 1)]
    fact = costs(spark, [("a", "t", d, 1) for d in wanted + outside])
    kept = rows(lookback_window(fact, date(2024, 2, 29)), "STARTDATE")
    assert [r[0] for r in kept] == wanted


def test_month_is_half_open(spark):
    days = [date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 29), date(2024, 3, 1)]
    df = spark.createDataFrame([(d,) for d in days], "STARTDATE date")
    kept = df.where(in_month(F.col("STARTDATE"), date(2024, 2, 10)))
    assert rows(kept, "STARTDATE") == [(days[1],), (days[2],)]


def test_run_date_is_one_day_after_the_processed_day():
    cfg = JobConfig(run_date=date(2024, 6, 1))
    assert cfg.as_of == date(2024, 5, 31)
    assert cfg.summary_month == date(2024, 6, 1)
    with pytest.raises(ValueError):
        JobConfig(gap_fill="sometimes")


GAPPY = [("a", 0, 1), ("b", 0, 2), ("a", 1, 3), ("b", 4, 5), ("a", 5, 6)]


def test_calendar_days(spark):
    assert len(rows(calendar_days(series(spark, GAPPY)), "STARTDATE")) == 6


def test_global_gap_fill_uses_last_service_before_the_gap(spark):
    got = rows(gap_fill(series(spark, GAPPY)), "STARTDATE", "SERVICE", "USD")
    assert [(d.day - 1, s, u) for d, s, u in got] == [
        (0, "a", 1.0), (0, "b", 2.0), (1, "a", 3.0), (2, "a", 0.0), (3, "a", 0.0),
        (4, "b", 5.0), (5, "a", 6.0),
    ]


def test_per_service_gap_fill_covers_the_whole_calendar(spark):
    got = rows(gap_fill(series(spark, GAPPY), "per_service"), "SERVICE", "STARTDATE", "USD")
    assert [u for s, _, u in got if s == "a"] == [1, 3, 0, 0, 0, 6]
    assert [u for s, _, u in got if s == "b"] == [2, 0, 0, 0, 5, 0]


def test_per_service_gap_fill_before_a_late_start(spark):
    late = series(spark, [("a", 0, 1), ("b", 2, 9), ("a", 3, 1)])
    got = rows(gap_fill(late, "per_service").where("SERVICE = 'b'"), "STARTDATE", "USD")
    assert [u for _, u in got] == [0, 0, 9, 0]


def test_gap_fill_can_be_off(spark):
    assert gap_fill(series(spark, GAPPY), "none").count() == len(GAPPY)
