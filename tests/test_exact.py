"""Amounts whose sums, scores and alerts do not depend on how the rows are dealt out."""

import json
import random
from dataclasses import replace
from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import DAY0, costs, rows
from spendtide.config import JobConfig
from spendtide.functions.numbers import EXACT, amount
from spendtide.operators.rollups import daily_cube, rollup
from spendtide.plans.daily_job import Alerts, lazily, load_costs, run
from spendtide.sources import facts


def exact(df):
    return df.withColumn("USD", F.col("USD").cast(EXACT))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 1000), st.integers(2, 13))
def test_same_alerts_for_any_number_of_partitions(spark, seed, parts):
    rnd = random.Random(seed)
    raw = [
        (rnd.choice("ab"), rnd.choice("xy"), d, rnd.choice([0.1, 0.2, 0.3, 1e-9, 1e9, -0.1, 7.7]))
        for d in range(40) for _ in range(rnd.randint(1, 9))
    ]
    rnd.shuffle(raw)
    cfg = JobConfig(run_date=DAY0 + timedelta(days=40), z_in=0.0, low_value_floor=-1e12, two_sided=True)
    found = []
    for n in (1, parts):
        cube = daily_cube(exact(costs(spark, raw)).repartition(n, F.rand(seed)))
        alerts = Alerts(cube, cfg, lazily)
        found.append([
            rows(alerts.svc_spike_testing, "SERVICE", "date", "svc_day_zscore"),
            rows(alerts.tag_spike_testing, "SERVICE", "TAG", "date", "svc_tag_day_zscore"),
            rows(alerts.svc_day, "SERVICE", "STARTDATE", "USD"),
        ])
    assert found[0] == found[1]


def test_sums_are_exact(spark):
    frame = exact(costs(spark, [("a", "x", 0, 0.1)] * 10 + [("a", "x", 0, 1e9), ("a", "x", 0, -1e9)]))
    assert rows(rollup(frame), "USD") == [(1.0,)]
    assert rows(daily_cube(frame), "USD") == [(Decimal("1.000000000000"),)]
    assert rows(rollup(daily_cube(frame)), "USD") == [(1.0,)]


def test_amount_text(spark):
    texts = spark.createDataFrame([("1E-7",), ("0.0000012345",), ("oops",), ("NaN",), ("1e30",), (None,)], "t string")
    found = [r[0] for r in texts.select(amount(F.col("t"), True)).collect()]
    assert found == [Decimal("0.000000100000"), Decimal("0.000001234500"), None, None, None, None]


def test_run_with_exact_amounts(spark, tmp_path):
    landed = tmp_path / "landing"
    landed.mkdir()
    day = date(2024, 5, 22)
    for n in range(30):
        d = day - timedelta(days=n)
        groups = [
            {"Keys": ["Compute", "Name$web"], "Metrics": {"UnblendedCost": {"Amount": a, "Unit": "USD"}}}
            for a in (["0.1"] * 10 if n else ["9.5", "0.25"])
        ]
        period = {"Start": str(d), "End": str(d + timedelta(days=1))}
        (landed / f"{d}.json").write_text(json.dumps({"ResultsByTime": [{"TimePeriod": period, "Groups": [
            {**g, "Keys": [g["Keys"][0], f"Name${k}"]} for k, g in enumerate(groups)
        ]}]}))
    cfg = JobConfig(
        run_date=day + timedelta(days=1), overlap_days=29, landing_path=str(landed), exact_amounts=True,
        fact_path=str(tmp_path / "fact"), output_path=str(tmp_path / "out"), state_path=str(tmp_path / "state"),
        write_enriched=True,
    )
    result = run(spark, cfg)
    table = facts.read_fact(spark, cfg.fact_path, exact=True)
    assert table.schema["USD"].dataType == EXACT and table.count() == 29 * 10 + 2
    sums = {r.STARTDATE: r.USD for r in result.alerts.svc_day.collect()}
    assert sums.pop(day) == 9.75 and set(sums.values()) == {1.0}
    assert rows(result.alerts.svc_spike_alerts, "SERVICE") == [("Compute",)]
    enriched = spark.read.parquet(f"{cfg.output_path}/enriched_fact")
    assert enriched.schema["USD"].dataType.simpleString() == "double" and enriched.count() == 292
    load_costs(spark, replace(cfg, overlap_days=3))
    assert facts.read_fact(spark, cfg.fact_path, exact=True).count() == 292


def test_kinds_of_amounts_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "fact")
    facts.append_fact(exact(costs(spark, [("a", "x", 0, 0.1)])), path)
    facts.merge_fact(exact(costs(spark, [("a", "x", 0, 0.1), ("a", "x", 0, 0.2)])), path, DAY0, DAY0)
    assert rows(facts.read_fact(spark, path, exact=True), "USD") == [(Decimal("0.100000000000"),), (Decimal("0.200000000000"),)]
    with pytest.raises(Exception, match="(?i)convert|type"):
        facts.read_fact(spark, path).collect()
