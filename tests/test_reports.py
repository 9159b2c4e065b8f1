import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from frames import DAY0, costs, rows, series
from spendtide.operators import messages
from spendtide.operators.series import macd_series, spike_series, summary_series
from spendtide.operators.summary import daily_spend, mtd_by_service, summarize
from spendtide.operators.trend import MACD, SIGNAL

AS_OF = date(2024, 1, 10)


def test_summaries_round_before_they_sum(spark):
    fact = costs(spark, [("a", "x", 0, 0.575), ("a", "x", 1, 0.575), ("a", "x", 40, 9), (None, "x", 1, 5)])
    assert rows(daily_spend(fact), "SERVICE", "DATE_STR", "TOTAL_SPEND")[0] == ("a", "20240101", 0.57)
    got = summarize(fact, date(2024, 2, 20), date(2024, 1, 15))
    assert rows(got.total_by_service, "*") == [("a", pytest.approx(1.14))]
    assert rows(got.daily_by_service, "DATE_STR", "SERVICE", "TOTAL_SPEND") == [
        ("20240101", "a", 0.57), ("20240102", "a", 0.57),
    ]


def test_summary_of_values_that_are_all_missing_is_zero(spark):
    assert rows(mtd_by_service(daily_spend(costs(spark, [("a", "x", 0, None)]))), "*") == [("a", 0.0)]


def test_summary_charts(spark):
    fact = costs(spark, [("a b", "x", 0, 1), ("c", "x", 1, 2)])
    got = summary_series(summarize(fact, AS_OF, AS_OF), AS_OF)
    assert rows(got, "chart_id", "DATE", "SERVICE", "TOTAL_SPEND") == [
        ("amz_dailySpendxService_20240110", date(2024, 1, 1), "a b", 1.0),
        ("amz_dailySpendxService_20240110", date(2024, 1, 2), "c", 2.0),
        ("amz_mtdSpendxService_20240110", None, "a b", 1.0),
        ("amz_mtdSpendxService_20240110", None, "c", 2.0),
    ]


def _alerted(spark, *services):
    return spark.createDataFrame([(s,) for s in services], "SERVICE string")


def test_spike_chart_has_the_latest_rows_and_strict_highlight(spark):
    svc_day = series(spark, [("long one", d, 1 + d % 2) for d in range(400)] + [("other", 0, 1)])
    whole = spike_series(svc_day, _alerted(spark, "long one"), AS_OF)
    assert whole.count() == 400 and {r.left_out for r in whole.collect()} == {0}
    got = spike_series(svc_day, _alerted(spark, "long one", "long one"), AS_OF, z_in=1.0, last_rows=365)
    assert got.count() == 365 and {r.left_out for r in got.collect()} == {35}
    first = got.agg(F.min("DATE")).first()[0]
    assert first == f"{DAY0 + timedelta(days=35):%Y%m%d}"
    assert {r.chart_id for r in got.collect()} == {"amz_tot_longone_20240110"}
    flat = spike_series(series(spark, [("a", d, 2) for d in range(5)]), _alerted(spark, "a"), AS_OF)
    assert {r.colour for r in flat.collect()} == {"blue"}
    single = spike_series(series(spark, [("a", 0, 2)]), _alerted(spark, "a"), AS_OF)
    assert [(r.threshold_line, r.colour) for r in single.collect()] == [(None, "blue")]
    peak = spike_series(series(spark, [("a", d, 2) for d in range(5)] + [("a", 5, 9)]), _alerted(spark, "a"), AS_OF)
    assert [r.DATE for r in peak.collect() if r.colour == "red"] == ["20240106"]


def test_macd_chart(spark):
    trend = spark.createDataFrame(
        [("a", DAY0, 0.575, 2.675), ("b", DAY0, 1.0, 1.0)],
        f"SERVICE string, date date, {MACD} double, {SIGNAL} double",
    )
    alerts = _alerted(spark, "a")
    assert rows(macd_series(trend, alerts, AS_OF), "*") == [("amz_a_20240110", "a", "20240101", 0.57, 2.68)]
    titled = macd_series(trend, alerts, AS_OF, region=F.lit("north")).first()
    assert titled.chart_title == "a (north)"
    assert macd_series(trend, alerts, AS_OF, title="T").first().chart_title == "T"


def _messages(spark, z=1.0, tags=None):
    trend = spark.createDataFrame(
        [("Up Service", 1), ('Quo"te\\', -1), ("Also Up", 1)], "SERVICE string, crossFlag int"
    )
    spikes = spark.createDataFrame(
        [("S One", 1.5), ("S Two", 3.0), ("S Null", None), ("S Down", -4.0), ("S Mid", 0.1)],
        "SERVICE string, svc_day_zscore double",
    )
    return messages.build_messages(spark, trend, spikes, AS_OF, z, tag_spike_alerts=tags)


def test_message_rows(spark):
    got = rows(_messages(spark), "section_no", "label", "rank", "text", "link")
    assert got == [
        (1, "AWS Services Summary", 1, "Daily Spend x Service", "amz_dailySpendxService_20240110"),
        (1, "AWS Services Summary", 2, "Month to Date Spend x Service", "amz_mtdSpendxService_20240110"),
        (2, "Downward Trending AWS Services", 1, 'Quo"te\\', 'amz_Quo"te\\_20240110'),
        (2, "Upward Trending AWS Services", 1, "Also Up", "amz_AlsoUp_20240110"),
        (2, "Upward Trending AWS Services", 2, "Up Service", "amz_UpService_20240110"),
        (3, "Spike down in AWS Services", 1, "S Down", "amz_tot_SDown_20240110"),
        (3, "Spike up in AWS Services", 1, "S Two", "amz_tot_STwo_20240110"),
        (3, "Spike up in AWS Services", 2, "S One", "amz_tot_SOne_20240110"),
    ]


def test_tag_section_is_optional(spark):
    tags = spark.createDataFrame([("a", "t 1", 2.0)], "SERVICE string, TAG string, svc_tag_day_zscore double")
    got = rows(_messages(spark, tags=tags).where("section_no = 4"), "label", "text", "link")
    assert got == [("Spike up in AWS Service Tags", "a / t 1", "amz_tag_a/t1_20240110")]


def test_no_alerts_leave_the_summary_only(spark):
    none = spark.createDataFrame([], "SERVICE string, crossFlag int, svc_day_zscore double")
    got = messages.build_messages(spark, none, none, AS_OF)
    assert rows(got.select("section").distinct(), "*") == [("awsSummary",)]


def test_top_alerts_and_date_labels(spark):
    df = spark.createDataFrame(
        [("b", 2.0, DAY0), ("a", 2.0, DAY0), ("c", 3.0, DAY0), ("d", None, DAY0)],
        "SERVICE string, z double, date date",
    )
    assert rows(messages.top_alerts(df, "z", 2), "SERVICE") == [("a",), ("c",)]
    got = messages.alert_rows(df, "z", 9, "s", "up", "down", 1.0, -1.0, "amz_", AS_OF, label_kind="date")
    assert {(r.text, r.link) for r in got.collect()} == {("2024-01-01", "amz_20240110")}
    with pytest.raises(ValueError):
        messages.alert_rows(df, "z", 9, "s", "up", "down", 1.0, -1.0, "amz_", AS_OF, label_kind="other")


def test_blocks_are_valid_json_in_message_order(spark):
    text = messages.message_text(messages.to_blocks(_messages(spark), "https://x")).first().blocks
    blocks = json.loads(text)
    assert [b["type"] for b in blocks] == [
        "rich_text", "section", "section", "rich_text", "section", "section", "rich_text", "section",
        "rich_text", "section", "section", "rich_text", "section",
    ]
    head = blocks[0]["elements"][0]["elements"][0]
    assert head == {"type": "text", "text": "AWS Services Summary:", "style": {"bold": True, "italic": True}}
    quoted = blocks[7]
    assert quoted["text"] == {"type": "mrkdwn", "text": 'Quo"te\\'}
    assert blocks[4]["accessory"] == {
        "type": "button", "text": {"type": "plain_text", "text": "Plot", "emoji": True},
        "value": "Plot", "url": "https://x/amz_AlsoUp_20240110.html", "action_id": "button-action",
    }


def test_payload(spark):
    got = {r.section: r.labels for r in messages.to_payload(_messages(spark)).collect()}
    assert set(got["awsTrends"]) == {"Upward Trending AWS Services", "Downward Trending AWS Services"}
    first = got["awsSvcSpikes"]["Spike up in AWS Services"][0]
    assert (first.text, first.link) == (["S Two"], "amz_tot_STwo_20240110")


def test_services_with_the_same_chart_name_keep_their_own_charts(spark):
    svc_day = series(spark, [("A B", 0, 1), ("AB", 0, 2), ("C", 0, 3)])
    alerts = _alerted(spark, "A B", "AB", "C")
    charts = rows(spike_series(svc_day, alerts, AS_OF), "chart_id", "chart_title")
    assert len({c for c, _ in charts}) == 3 and ("amz_tot_AB_20240110", "A B") in charts
    links = messages.alert_rows(
        alerts.withColumn("s", F.lit(2.0)), "s", 3, "x", "up", "down", 1, -1, "amz_tot_", AS_OF
    )
    assert rows(links, "link", "text") == charts


def test_no_alert_is_cut_from_the_messages(spark):
    alerts = spark.range(3000).selectExpr("concat('s', id) AS SERVICE", "double(id + 2) AS svc_day_zscore")
    nothing = spark.createDataFrame([], "SERVICE string, crossFlag int")
    built = messages.build_messages(spark, nothing, alerts, AS_OF)
    pages = messages.message_pages(messages.to_blocks(built, "https://x")).collect()
    assert sorted(p.message_no for p in pages) == list(range(1, len(pages) + 1))
    blocks = [b for p in sorted(pages, key=lambda p: p.message_no) for b in json.loads(p.blocks)]
    assert all(len(json.loads(p.blocks)) <= 50 for p in pages)
    texts = [b["text"]["text"] for b in blocks if b["type"] == "section"]
    assert texts[2:] == [f"s{n}" for n in reversed(range(3000))]
    assert messages.alert_rows(
        alerts, "svc_day_zscore", 3, "x", "up", "down", 1, -1, "p", AS_OF, top_n=7
    ).count() == 7


def test_messages_are_bounded_by_bytes(spark):
    names = [f"s{n:02d}" + "é" * (n * 13 % 400) for n in range(40)] + ["x" * 5000]
    alerts = spark.createDataFrame([(n, 99.0 - k) for k, n in enumerate(names)], "SERVICE string, svc_day_zscore double")
    nothing = spark.createDataFrame([], "SERVICE string, crossFlag int")
    blocks = messages.to_blocks(messages.build_messages(spark, nothing, alerts, AS_OF), "https://x")
    pages = sorted(messages.message_pages(blocks, 7, 3000).collect(), key=lambda p: p.message_no)
    assert [p.message_no for p in pages] == list(range(1, len(pages) + 1)) and len(pages) > 44 / 7 + 1
    found = [json.loads(p.blocks) for p in pages]
    assert all(len(b) == 1 or (len(b) <= 7 and len(p.blocks.encode()) <= 3000 + 2) for b, p in zip(found, pages))
    assert [b["text"]["text"] for f in found for b in f if b["type"] == "section"][2:] == names


def test_payload_comes_in_parts(spark):
    parts = messages.to_payload(_messages(spark), 2).orderBy("section", "part_no").collect()
    assert [(r.section, r.part_no, sum(map(len, r.labels.values()))) for r in parts] == [
        ("awsSummary", 1, 2), ("awsSvcSpikes", 1, 2), ("awsSvcSpikes", 2, 1),
        ("awsTrends", 1, 2), ("awsTrends", 2, 1),
    ]


def test_no_task_ranks_a_label(spark):
    """Alerts of one label are numbered by ranges, and no window holds the label."""
    alerts = spark.range(50_000).selectExpr("concat('s', id) AS SERVICE", "double(id + 2) AS z")
    lines = messages.alert_lines(alerts, "z", 3, "x", "up", "down", 1, -1, "p", AS_OF)
    text = messages.ranked(lines)._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in text and "label_no#" not in "".join(
        line for line in text.splitlines() if "Window [" in line
    )
    found = messages.ranked(lines).where("rank <= 3")
    assert rows(found, "rank", "text") == [(1, "s49999"), (2, "s49998"), (3, "s49997")]
