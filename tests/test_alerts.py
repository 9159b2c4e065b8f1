from dataclasses import replace
from datetime import date, timedelta

import pytest

from frames import DAY0, costs, rows
from spendtide.config import JobConfig
from spendtide.operators.gapfill import gap_fill
from spendtide.operators.rollups import daily_cube, rollup
from spendtide.operators.spikes import detect_spikes
from spendtide.operators.suppress import anti_suppress, low_value_keys, tagged
from spendtide.operators.trend import trend_lines
from spendtide.plans.daily_job import Alerts, enrich, enriched, lazily

LAST = DAY0 + timedelta(days=9)
CFG = JobConfig(run_date=LAST + timedelta(days=1))


def _fact(spark):
    base = [(s, t, d, 1 + d % 2) for s in ("a", "b", "c") for t in ("x", "", None) for d in range(9)]
    peak = [("a", "x", 9, 50), ("a", "", 9, 50), ("b", "x", 9, 60), ("c", None, 9, 70), ("c", "x", 9, 9)]
    return costs(spark, base + peak + [("b", "", 9, -3.0), ("a", "y", 9, 0.01)])


def test_spike_cut_off_is_inclusive(spark):
    scores = spark.createDataFrame(
        [("a", LAST, 1.0), ("b", LAST, 0.999), ("c", LAST, None), ("d", LAST, -2.0), ("e", DAY0, 5.0)],
        "SERVICE string, date date, z double",
    )
    assert rows(detect_spikes(scores, "z", LAST), "SERVICE") == [("a",)]
    assert rows(detect_spikes(scores, "z", LAST, two_sided=True), "SERVICE") == [("a",), ("d",)]


def test_low_value_rules(spark):
    fact = costs(spark, [
        ("a", "x", 9, 0.005), ("a", "x", 9, 7), ("b", "y", 9, -3), ("c", None, 9, 0.0),
        ("d", "z", 9, 0.01), ("e", "x", 8, 0.001),
    ])
    for source in (fact, daily_cube(fact)):
        assert rows(low_value_keys(source, LAST), "SERVICE", "TAG") == [("a", "x"), ("b", "y"), ("c", None)]
        assert rows(low_value_keys(source, LAST, keys=["SERVICE"]), "SERVICE") == [("a",), ("b",), ("c",)]
        total = low_value_keys(source, LAST, keys=["SERVICE"], on="service_total")
        assert rows(total, "SERVICE") == [("b",), ("c",)]


def test_suppression_matches_null_tags(spark):
    found = spark.createDataFrame([("a", None), ("a", ""), ("b", "x")], "SERVICE string, TAG string")
    low = spark.createDataFrame([("a", None), ("c", "x")], "SERVICE string, TAG string")
    kept = anti_suppress(found, low, ["SERVICE", "TAG"])
    assert rows(kept, "SERVICE", "TAG") == [("a", ""), ("b", "x")]
    assert rows(tagged(found), "TAG") == [("",), ("x",)]
    assert rows(tagged(found, drop_empty=True), "TAG") == [("x",)]


@pytest.mark.parametrize("through_cube", [False, True])
def test_alert_frames(spark, through_cube):
    fact = _fact(spark)
    found = Alerts(daily_cube(fact) if through_cube else fact, CFG, lazily)
    # b has a credit, which hides the whole service but only that tag.
    assert rows(found.svc_spike_alerts, "SERVICE") == [("a",), ("c",)]
    assert rows(found.tag_spike_alerts, "SERVICE", "TAG") == [("a", ""), ("a", "x"), ("b", "x"), ("c", "x")]
    assert "STARTDATE" not in found.svc_spike_alerts.columns + found.trend_alerts.columns
    assert found.svc_spike_testing.count() == found.svc_day.count() == 30
    strict = Alerts(fact, replace(CFG, drop_empty_tag=True, suppress_on="service_total"), lazily)
    assert rows(strict.svc_spike_alerts, "SERVICE") == [("a",), ("b",), ("c",)]
    assert rows(strict.tag_spike_alerts, "SERVICE", "TAG") == [("a", "x"), ("b", "x"), ("c", "x")]


def test_stored_frames_give_the_same_alerts(spark):
    fact = _fact(spark)
    lazy, stored = Alerts(fact, CFG, lazily), Alerts(fact, CFG)
    for name in ("trend_alerts", "trend_testing", "svc_spike_alerts", "tag_spike_alerts"):
        assert rows(getattr(lazy, name), "*") == rows(getattr(stored, name), "*")


def test_enriched_keeps_every_row_once(spark):
    fact = costs(spark, [
        ("a", "x", 0, 1), ("a", "x", 0, 1), ("a", None, 0, 3), ("a", "x", 1, 5), ("b", "y", 3, 2),
        ("a", "x", 8, 2), (None, "x", 1, 4),
    ])
    lines = trend_lines(gap_fill(rollup(fact)))
    got = enrich(fact, daily_cube(fact), lines, keep=lazily)
    assert got.count() == fact.count()
    assert len(got.columns) == 9 + 16 + 4
    by_key = {(r.SERVICE, r.TAG, r.STARTDATE): r for r in got.collect()}
    untagged = by_key[("a", None, DAY0)]
    assert untagged.svc_tag_day_zscore is None and untagged.svc_tag_wk_usd_mean is None
    assert untagged.svc_day_usd_max == 5.0 and untagged.svc_wk_usd_min == 2.0
    tag = by_key[("a", "x", DAY0)]
    assert (tag.svc_tag_day_usd_min, tag.svc_tag_day_usd_max) == (2.0, 5.0)
    assert (tag.svc_tag_wk_usd_min, tag.svc_tag_wk_usd_max, tag.svc_tag_wk_usd_mean) == (2.0, 7.0, 4.5)
    assert by_key[(None, "x", DAY0 + timedelta(days=1))].svc_day_zscore is None


def test_enriched_limits_itself_to_the_window(spark):
    fact = costs(spark, [("a", "x", d, d) for d in range(10)] + [("a", "x", date(2022, 1, 1), 1)])
    assert enriched(fact, CFG).count() == 10
