import math
from datetime import date

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import costs, rows, series
from spendtide.functions.numbers import amount, round2
from spendtide.operators.rollups import daily_cube, rollup
from spendtide.operators.stats import moments, zscore

FACT = [
    ("a", "x", 0, 1), ("a", "x", 0, 2), ("a", None, 0, 4), ("a", "", 1, 8), ("b", "x", 1, -3),
    (None, "x", 1, 100), ("b", "y", 8, None),
]


@pytest.mark.parametrize("through_cube", [False, True])
def test_rollups(spark, through_cube):
    fact = costs(spark, FACT)
    source = daily_cube(fact) if through_cube else fact
    got = rows(rollup(source), "SERVICE", "STARTDATE", "USD")
    assert [(s, d.day, u) for s, d, u in got] == [("a", 1, 7.0), ("a", 2, 8.0), ("b", 2, -3.0), ("b", 9, 0.0)]
    got = rows(rollup(source, "svc_tag", "day"), "SERVICE", "TAG", "STARTDATE", "USD")
    assert [(s, t, d.day, u) for s, t, d, u in got] == [
        ("a", "", 2, 8.0), ("a", "x", 1, 3.0), ("b", "x", 2, -3.0), ("b", "y", 9, 0.0),
    ]
    assert rows(rollup(source, "svc", "week"), "SERVICE", "yearWK", "USD") == [
        ("a", 202401, 15.0), ("b", 202401, -3.0), ("b", 202402, 0.0),
    ]
    assert ("a", "x", 202401, 3.0) in rows(rollup(source, "svc_tag", "week"), "SERVICE", "TAG", "yearWK", "USD")


def test_year_end_week_joins_january_unless_iso(spark):
    fact = costs(spark, [("a", "x", date(2024, 1, 2), 1), ("a", "x", date(2024, 12, 30), 2)])
    assert rows(rollup(fact, "svc", "week"), "yearWK", "USD") == [(202401, 3.0)]
    assert rows(rollup(fact, "svc", "week", iso_year=True), "yearWK", "USD") == [(202401, 1.0), (202501, 2.0)]


def test_zscore_is_null_where_undefined(spark):
    df = series(spark, [("one", 0, 5), ("flat", 0, 0.1), ("flat", 1, 0.1), ("flat", 2, 0.1),
                        ("a", 0, 1), ("a", 1, 2), ("a", 2, 3)])
    got = {(s, d.day): z for s, d, z in rows(zscore(df, ["SERVICE"], "z"), "SERVICE", "STARTDATE", "z")}
    assert got[("one", 1)] is None and got[("flat", 2)] is None
    assert [got[("a", d)] for d in (1, 2, 3)] == [-1.0, 0.0, 1.0]
    # NaN would pass this filter in Spark.
    assert zscore(df, ["SERVICE"], "z").where(F.col("z") >= 1).count() == 1


def test_not_a_number_never_alerts(spark):
    fact = costs(spark, [("a", "x", 0, 1), ("a", "x", 1, float("nan")), ("a", "x", 2, 3)])
    assert rows(rollup(fact), "USD") == [(0.0,), (1.0,), (3.0,)]
    endless = series(spark, [("a", 0, 1), ("a", 1, 2), ("a", 2, float("inf"))])
    assert rows(zscore(endless, ["SERVICE"], "z"), "z") == [(None,)] * 3


def test_moments(spark):
    df = series(spark, [("a", 0, 1), ("a", 1, 2), ("a", 2, 6)])
    got = moments(df, ["SERVICE"], "svc_day")
    assert rows(got, "svc_day_usd_min", "svc_day_usd_max", "svc_day_usd_mean") == [(1.0, 6.0, 3.0)]


def test_round2_follows_scaled_half_even(spark):
    values = [0.575, 2.675, 1.005, 0.285, -0.575]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(round2(F.col("v"))).collect()]
    assert got == [0.57, 2.68, 1.0, 0.28, -0.57] == list(np.round(values, 2))


def test_amounts(spark):
    texts = ["0.0000012345", "1E-7", "-3.5", "n/a", "NaN", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(amount(F.col("t"))).collect()]
    assert got[:3] == [1.2345e-06, 1e-07, -3.5] and got[3:] == [None, None, None]
    assert not any(isinstance(v, float) and math.isnan(v) for v in got)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**6, 10**6), min_size=2, max_size=60))
def test_scores_have_mean_zero_and_deviation_one(spark, cents):
    df = zscore(series(spark, [("a", i, v / 100) for i, v in enumerate(cents)]), ["SERVICE"], "z")
    z = [r.z for r in df.collect()]
    if len(set(cents)) == 1:
        assert set(z) == {None}
    else:
        assert abs(np.mean(z)) < 1e-7 and abs(np.std(z, ddof=1) - 1) < 1e-7
