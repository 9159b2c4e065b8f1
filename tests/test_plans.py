"""Shapes of the physical plans."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from spendtide.operators.enrich import tag_stats
from spendtide.operators.gapfill import gap_fill
from spendtide.operators.rollups import daily_cube, rollup
from spendtide.operators.stats import zscore
from spendtide.operators.trend import macd, trend_lines
from spendtide.plans import catalog, daily_job
from spendtide.sources.adapters import as_costs, events_as_costs, orders_as_costs

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r" Exchange ", plan(df)))


# Plans that only read back what a run or a refresh has stored say nothing of its making.
STORED = ("stored_messages", "stored_enriched", "stored_alert", "daily_runs_kept", "moments_kept")


@pytest.mark.parametrize("name", [n for n in catalog.queries() if not n.startswith(STORED)])
def test_no_python_and_no_pairing_joins(spark, name):
    text = plan(catalog.queries()[name](spark, FOLDER))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval"):
        assert bad not in text


def test_window_predicate_and_columns_reach_the_scan(spark):
    text = plan(rollup(catalog.lookback(spark, FOLDER)))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,1996-08-12" in text
    assert "LessThan(o_orderdate,1997-08-13" in text
    assert "o_custkey" not in text


def test_month_predicate_passes_the_aggregation(spark):
    text = plan(daily_job.summaries(
        orders_as_costs(spark, FOLDER), catalog.ORDERS_RUN
    ).total_by_service)
    assert "GreaterThanOrEqual(o_orderdate,1997-08-01" in text


def test_rollup_aggregates_before_its_only_shuffle(spark):
    df = daily_cube(events_as_costs(spark, FOLDER))
    text = plan(df)
    assert exchanges(df) == 1 and "partial_sum" in text


def test_service_chain_shares_one_exchange(spark):
    day = rollup(orders_as_costs(spark, FOLDER))
    assert exchanges(zscore(day, ["SERVICE"], "z")) == 2
    lines = trend_lines(day, signal_scope="service")
    assert exchanges(zscore(lines, ["SERVICE"], "z")) == 2
    means = plan(macd(day))  # both spans, their blocks and what is carried share one sort
    assert len(re.findall(r" Sort \[", means)) == 1 and "Generate" not in means


def test_gap_fill_reads_the_fact_once(spark):
    filled = gap_fill(rollup(orders_as_costs(spark, FOLDER)))
    filled.collect()
    final = plan(filled).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_pages_on_lines_take_one_scan(spark):
    text = plan(catalog.queries()["flatten_cost_pages"](spark, FOLDER))
    assert text.count("FileScan text") == 1 and "Window" not in text and "Exchange" not in text


def test_tag_statistics_share_one_exchange(spark):
    cube = daily_cube(orders_as_costs(spark, FOLDER))
    tags = tag_stats(cube).select("SERVICE", "TAG", "svc_tag_day_zscore", "svc_tag_wk_zscore")
    text = plan(tags)
    assert len(re.findall(r"Exchange hashpartitioning\(SERVICE#\d+, TAG#\d+, \d+\)", text)) == 1
    assert "yearWK#" not in "".join(re.findall(r"Exchange hashpartitioning.*", text))


def test_stored_statistics_leave_the_fact_unshuffled_while_small(spark):
    text = plan(catalog.queries()["enriched_fact"](spark, FOLDER))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(catalog.queries()["enriched_fact"](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_split_when_statistics_are_large(spark):
    """Two thirds of the fact under one (service, tag, day), with both sides sorted."""
    rows = spark.range(300_000, numPartitions=8)
    hot = F.col("id") % 3 < 2
    fact = as_costs(
        rows,
        F.when(hot, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)),
        F.when(hot, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 7)),
        F.when(hot, F.lit(date(2024, 1, 1))).otherwise(
            F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 90).cast("int"))
        ),
        F.xxhash64("id") / 1e15,
    )
    lines = trend_lines(gap_fill(rollup(fact)), signal_scope="service")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "400k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = daily_job.enrich(fact, daily_cube(fact), lines)
        assert joined.toArrow().num_rows == 300_000
        assert "SortMergeJoin(skew=true)" in plan(joined).split("Initial Plan")[0]
    finally:
        for name in settings:
            spark.conf.unset(name)
