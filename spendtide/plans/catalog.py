"""Named queries over the given tables, each through the public operators.

Computed doubles are rounded so that another engine's sum order does not show:
amounts to 3 places (their magnitude leaves 9 or more digits), means and scores to 6.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendtide.config import JobConfig
from spendtide.functions.dates import (
    add_date_parts, date_from_parts, date_key, lookback_window, months_back, year_week,
)
from spendtide.functions.numbers import EXACT, amount, round2
from spendtide.functions.text import SPIKE_PREFIX, chart_name, chart_title, clean_tag
from spendtide.operators import messages, series
from spendtide.operators.ewm import ewm
from spendtide.operators.gapfill import calendar_days, gap_fill
from spendtide.operators.moment_states import moments_of
from spendtide.operators.numbering import numbered
from spendtide.operators.rollups import LEVELS, daily_cube, rollup
from spendtide.operators.spikes import SVC_SCORE, TAG_SCORE
from spendtide.operators.stats import moments, zscore
from spendtide.operators.summary import (
    daily_by_service, daily_spend, month_to_date, mtd_by_service,
)
from spendtide.operators.suppress import low_value_keys
from spendtide.operators.trend import (
    FAST, MACD, PLACE, SIGNAL, SLOW, by_place, cross_flag, macd, signal, trend_lines, trend_series,
)
from spendtide.plans import daily_job
from spendtide.plans.kept import KeptState
from spendtide.plans.materialize import materialize, new_path
from spendtide.schema import COST_EXTRACT
from spendtide.sources import facts, landing, sinks
from spendtide.sources.adapters import events_as_costs, lineitem_as_costs, orders_as_costs

Query = Callable[[SparkSession, str], DataFrame]

# The processed day of each table. Orders look back one year, as a daily run does;
# events span one month and lineitem looks back over everything, so both use the
# whole table. The amounts of these tables are large, hence the suppression floors.
ORDERS_RUN = JobConfig(run_date=date(1997, 8, 13), low_value_floor=10000.0)
EVENTS_RUN = JobConfig(run_date=date(2024, 1, 31), low_value_floor=0.1)
LINEITEM_RUN = JobConfig(run_date=date(2001, 11, 5), lookback_months=120, low_value_floor=1000.0)
# A year with days on which no service has data.
GAP_RUN = JobConfig(run_date=date(1998, 6, 16))
# All orders.
WHOLE_RUN = JobConfig(run_date=date(2001, 8, 2), lookback_months=120)
SMOKE_RUN = JobConfig(run_date=date(1998, 6, 13))
# The corrected variant of every switchable behaviour.
STRICT_RUN = replace(
    ORDERS_RUN, gap_fill="per_service", signal_scope="service", macd_sign="standard",
    suppress_on="service_total", low_value_floor=300000.0, two_sided=True,
    drop_empty_tag=True, message_tag_spikes=True,
)

# Where the stored events table ends before its second, overlapping load.
EVENTS_SPLIT = date(2024, 1, 23)
ORDERS_SPLIT = date(1998, 6, 15)
KEPT_SPLIT = date(1997, 7, 20)

AMOUNTS = (
    "USD", "TOTAL_SPEND", "MACD", "9EWM", "mean_line", "threshold_line", FAST, SLOW, MACD, SIGNAL,
)


def _fixed(df: DataFrame) -> DataFrame:
    """Round the double columns; adding 0.0 turns a negative zero into zero."""
    def places(name: str) -> int:
        return 3 if name in AMOUNTS or name.endswith(("_min", "_max")) else 6

    return df.select(*[
        (F.round(f"`{n}`", places(n)) + F.lit(0.0)).alias(n) if t == "double" else F.col(f"`{n}`")
        for n, t in df.dtypes
    ])


# -- scans, projections, filters ------------------------------------------------


def cost_fact(spark: SparkSession, folder: str) -> DataFrame:
    return orders_as_costs(spark, folder)


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/orders.parquet")


def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    days = _orders(spark, folder).select(
        F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("STARTDATE")
    )
    rebuilt = date_from_parts(F.col("YEAR"), F.col("MONTH"), F.col("DAY")).alias("rebuilt")
    return add_date_parts(days).select("*", rebuilt)


def year_week_keys(spark: SparkSession, folder: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return _orders(spark, folder).select(
        F.col("o_orderkey").alias("id"),
        year_week(day).alias("yearWK"),
        year_week(day, iso_year=True).alias("isoYearWK"),
    )


def date_keys(spark: SparkSession, folder: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return _orders(spark, folder).select(
        F.col("o_orderkey").alias("id"),
        date_key(day).alias("DATE_STR"),
        F.to_date(date_key(day), "yyyyMMdd").alias("parsed"),
    )


def tag_clean(spark: SparkSession, folder: str) -> DataFrame:
    tag = F.concat(F.lit("Name$"), F.col("o_orderpriority"))
    return _orders(spark, folder).select(
        F.col("o_orderkey").alias("id"),
        clean_tag(tag).alias("TAG"),
        clean_tag(tag, double_strip=True).alias("cut_tag"),
        chart_name(SPIKE_PREFIX, F.col("o_orderpriority"), ORDERS_RUN.as_of).alias("link"),
        chart_title(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("title"),
    )


def amount_round2(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return lines.select(
        "l_orderkey", "l_linenumber", round2(net).alias("net"),
        amount(F.col("l_returnflag")).alias("unreadable"),
        amount(F.col("l_linenumber").cast("string")).alias("readable"),
    )


def lookback(spark: SparkSession, folder: str) -> DataFrame:
    costs = lookback_window(orders_as_costs(spark, folder), ORDERS_RUN.as_of)
    return costs.select("SERVICE", "TAG", "STARTDATE", "USD")


def month_filter(spark: SparkSession, folder: str) -> DataFrame:
    costs = orders_as_costs(spark, folder).select("SERVICE", "TAG", "STARTDATE", "USD")
    return month_to_date(costs, ORDERS_RUN.summary_month)


def low_value_tags(spark: SparkSession, folder: str) -> DataFrame:
    return low_value_keys(
        events_as_costs(spark, folder), EVENTS_RUN.as_of, EVENTS_RUN.low_value_floor
    )


def low_value_totals(spark: SparkSession, folder: str) -> DataFrame:
    return low_value_keys(
        events_as_costs(spark, folder), EVENTS_RUN.as_of, 5.0, on="service_total"
    )


# -- ingest and storage ---------------------------------------------------------


def _as_pages(costs: DataFrame) -> DataFrame:
    """Cost rows as pages with one group each."""
    group = F.struct(
        F.array(F.col("SERVICE"), F.concat(F.lit("Name$"), "TAG")).alias("Keys"),
        F.create_map(
            F.lit("UnblendedCost"),
            F.struct(F.col("USD").cast("string").alias("Amount"), F.lit("USD").alias("Unit")),
        ).alias("Metrics"),
    )
    period = F.struct(
        F.col("STARTDATE").cast("string").alias("Start"),
        F.col("ENDDATE").cast("string").alias("End"),
    )
    result = F.struct(period.alias("TimePeriod"), F.array(group).alias("Groups"))
    return costs.select("TAG", F.array(result).alias("ResultsByTime"))


def _land(costs: DataFrame, path: str) -> None:
    """Write cost rows as page files, one page with one group per line."""
    _as_pages(costs).drop("TAG").write.json(path)


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed as page files and read back."""
    path = new_path(spark, "pages")
    _land(orders_as_costs(spark, folder), path)
    return landing.read_cost_pages(spark, path)


def _landed_text(spark: SparkSession, pages: DataFrame, text: Column) -> DataFrame:
    """Pages landed as files with ``text`` for each and read back."""
    path = new_path(spark, "pages")
    pages.select(text.alias("value")).write.text(path)
    return landing.read_cost_pages(spark, path)


def pages_mixed_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed in every layout, by status: one page on a line, indented pages one
    after the other in a file, and two pages on a line."""
    pages = _as_pages(orders_as_costs(spark, folder))
    page = F.struct("ResultsByTime")
    line, indented = F.to_json(page), F.to_json(page, {"pretty": "true"})
    text = (
        F.when(F.col("TAG") == "F", line)
        .when(F.col("TAG") == "O", indented)
        .otherwise(F.concat(line, F.lit(" "), F.lit('{"ResultsByTime":[]}')))
    )
    return landing.landed_costs(_landed_text(spark, pages, text))


def rejected_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed with those of one status cut off and those of another without
    results: what the load rejects, counted by reason."""
    pages = _as_pages(orders_as_costs(spark, folder))
    line = F.to_json(F.struct("ResultsByTime"))
    text = (
        F.when(F.col("TAG") == "P", F.substring(line, 1, 40))
        .when(F.col("TAG") == "F", F.lit('{"NextPageToken":"x"}'))
        .otherwise(line)
    )
    bad = landing.rejected(_landed_text(spark, pages, text))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


def rejected_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with grouped digits in the amounts of one status: rejected, not counted as 0."""
    costs = orders_as_costs(spark, folder)
    grouped = F.when(F.col("TAG") == "P", F.format_number("USD", 2)).otherwise(F.col("USD").cast("string"))
    path = new_path(spark, "pages")
    _land(costs.withColumn("USD", grouped), path)
    pages = landing.read_cost_pages(spark, path)
    bad = landing.rejected(pages).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))
    good = landing.landed_costs(pages).agg(F.count(F.lit(1)).alias("records"))
    return bad.unionByName(good.select(F.lit("loaded").alias("reason"), "records"))


def missing_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days of a month that no landed page reports on."""
    last = GAP_RUN.as_of
    return landing.missing_days(_pages(spark, folder), last - timedelta(days=30), last)


def flatten_cost_pages(spark: SparkSession, folder: str) -> DataFrame:
    return landing.landed_costs(_pages(spark, folder))


def overlap_load(spark: SparkSession, folder: str) -> DataFrame:
    first, last = landing.overlap_window(ORDERS_RUN.as_of, ORDERS_RUN.overlap_days)
    return landing.landed_costs(_pages(spark, folder), first, last)


def export_headers(spark: SparkSession, folder: str) -> DataFrame:
    names = {new: old for old, new in landing.EXPORT_HEADERS.items()}
    old = orders_as_costs(spark, folder).select(*COST_EXTRACT.names).withColumnsRenamed(names)
    return landing.to_fact(landing.normalize_columns(old))


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    return calendar_days(orders_as_costs(spark, folder))


def _overlapping(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders up to a day, and from seven days before it on."""
    costs = orders_as_costs(spark, folder)
    day = F.col("STARTDATE")
    return (
        costs.where(day <= F.lit(ORDERS_SPLIT)),
        costs.where(day >= F.lit(ORDERS_SPLIT - timedelta(days=7))),
    )


def compact_distinct(spark: SparkSession, folder: str) -> DataFrame:
    history, batch = _overlapping(spark, folder)
    return facts.merged(history, batch)


def compact_latest(spark: SparkSession, folder: str) -> DataFrame:
    history, batch = _overlapping(spark, folder)
    restated = batch.withColumn("USD", F.col("USD") + 1.0)
    return facts.merged(history, restated, "latest")


def stored_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Store events, append an overlapping load, compact, merge again, read back."""
    path = new_path(spark, "stored_merge")
    costs = events_as_costs(spark, folder)
    day = F.col("STARTDATE")
    first = EVENTS_SPLIT - timedelta(days=7)
    late = costs.where(day >= F.lit(first))
    facts.overwrite_fact(costs.where(day <= F.lit(EVENTS_SPLIT)), path)
    facts.append_fact(late, path)
    facts.compact_fact(spark, path, first, EVENTS_SPLIT)
    facts.merge_fact(late, path, first, EVENTS_RUN.as_of)
    return facts.read_fact(spark, path)


def overwrite_existing(spark: SparkSession, folder: str) -> DataFrame:
    """Overwrite a filled table with replaced days by restated rows and read back."""
    path = new_path(spark, "overwritten")
    costs = events_as_costs(spark, folder)
    facts.append_fact(costs, path)
    facts.merge_fact(costs, path, EVENTS_SPLIT, EVENTS_RUN.as_of)
    facts.overwrite_fact(costs.withColumn("USD", F.col("USD") + 1.0), path)
    return facts.read_fact(spark, path)


def append_after_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Store events, merge an overlapping load twice, append restated rows, read back."""
    path = new_path(spark, "append_after_merge")
    costs = events_as_costs(spark, folder)
    facts.append_fact(costs, path)
    for _ in range(2):
        facts.merge_fact(costs, path, EVENTS_SPLIT, EVENTS_RUN.as_of)
    restated = costs.where(F.col("STARTDATE") >= F.lit(EVENTS_SPLIT))
    facts.append_fact(restated.withColumn("USD", F.col("USD") + 1.0), path)
    return facts.read_fact(spark, path)


def interleaved_writers(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of the same days, of which the second begins and commits while the first
    one is at work, which is then worked out again."""
    path = new_path(spark, "interleaved")
    costs = events_as_costs(spark, folder)
    days = EVENTS_SPLIT, EVENTS_RUN.as_of
    facts.append_fact(costs, path)
    others = [costs.withColumn("USD", F.col("USD") + 2.0)]

    def first_load(history: DataFrame) -> DataFrame:
        if others:
            facts.merge_fact(others.pop(), path, *days)
        return facts.merged(history, costs.withColumn("USD", F.col("USD") + 1.0))

    facts.replace_days(spark, path, *days, first_load)
    return facts.read_fact(spark, path)


# -- rollups, moments, scores ---------------------------------------------------

SOURCES = {"": orders_as_costs, "_events": events_as_costs, "_lineitem": lineitem_as_costs}
LEVEL_GRAINS = [(level, grain) for level in ("svc", "svc_tag") for grain in ("day", "week")]
SHORT = {"day": "day", "week": "wk"}


def _keys(level: str) -> list[str]:
    return ["SERVICE"] if level == "svc" else ["SERVICE", "TAG"]


def _rollup(source, level: str, grain: str) -> Query:
    return lambda spark, folder: _fixed(rollup(source(spark, folder), level, grain))


def _moments(source, level: str, grain: str) -> Query:
    return lambda spark, folder: _fixed(
        moments(
            rollup(source(spark, folder), level, grain), _keys(level), f"{level}_{SHORT[grain]}"
        )
    )


def _zscore(source, level: str, grain: str) -> Query:
    return lambda spark, folder: _fixed(
        zscore(
            rollup(source(spark, folder), level, grain),
            _keys(level), f"{level}_{SHORT[grain]}_zscore",
        ).drop("USD")
    )


def _kept(
    spark: SparkSession, folder: str, source, split: date, cfg: JobConfig, levels: tuple[str, ...]
) -> KeptState:
    """The state of a run's window of costs that was loaded out of order: the late days
    first, with amounts restated later, then all others; refreshed after each load."""
    base = new_path(spark, "kept")
    costs = lookback_window(source(spark, folder), cfg.as_of, cfg.lookback_months)
    path = f"{base}/fact"
    late = F.col("STARTDATE") >= F.lit(split)
    kept = KeptState(spark, path, f"{base}/state")
    loads = [
        lambda: facts.append_fact(costs.where(late).withColumn("USD", F.col("USD") * 2), path),
        lambda: facts.replace_days(spark, path, split, cfg.as_of, lambda _: costs),
        lambda: facts.append_fact(costs.where(~late), path),
    ]
    for load in loads:
        load()
        for level in levels:
            kept.refreshed_months(level)
    return kept


# A year of whole months with parts of two, and a single part of a month.
KEPT = {
    "": (orders_as_costs, KEPT_SPLIT, ORDERS_RUN),
    "_events": (events_as_costs, EVENTS_SPLIT, EVENTS_RUN),
}


def _moments_kept(source, split: date, cfg: JobConfig, level: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        kept = _kept(spark, folder, source, split, cfg, (level,))
        states = kept.states(level, months_back(cfg.as_of, cfg.lookback_months), cfg.as_of)
        return _fixed(moments_of(states, LEVELS[level], f"{level}_day"))

    return query


def spike_alerts_tag_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Tag spikes by moments that were kept while the fact was loaded out of order."""
    cfg = ORDERS_RUN
    kept = _kept(spark, folder, orders_as_costs, KEPT_SPLIT, cfg, ("svc_tag",))
    since = months_back(cfg.as_of, cfg.lookback_months)
    found = daily_job.Alerts(
        kept.cube.read(since, cfg.as_of), cfg, tag_states=kept.states("svc_tag", since, cfg.as_of)
    )
    return _fixed(found.tag_spike_alerts)


def zscore_svc_day_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of daily sums that do not depend on the order of the rows."""
    costs = orders_as_costs(spark, folder).withColumn("USD", F.col("USD").cast(EXACT))
    scored = zscore(rollup(costs, "svc", "day"), ["SERVICE"], SVC_SCORE, order="STARTDATE")
    return _fixed(scored.withColumn("USD", round2(F.col("USD"))))


def zscore_svc_day_filled(spark: SparkSession, folder: str) -> DataFrame:
    return _fixed(zscore(_filled(spark, folder), ["SERVICE"], SVC_SCORE))


def rollup_svc_week_iso(spark: SparkSession, folder: str) -> DataFrame:
    return _fixed(rollup(orders_as_costs(spark, folder), "svc", "week", iso_year=True))


def cube(spark: SparkSession, folder: str) -> DataFrame:
    return _fixed(daily_cube(events_as_costs(spark, folder)))


# -- calendar and trend ---------------------------------------------------------


def _filled(
    spark: SparkSession, folder: str, source=orders_as_costs, mode: str = "global"
) -> DataFrame:
    """The service series of a whole table, stored: what follows reads it repeatedly."""
    sums = rollup(source(spark, folder), "svc", "day")
    if mode == "per_service":
        sums = materialize(sums, "svc_sums")
    return materialize(gap_fill(sums, mode), "svc_day")


def _placed(spark: SparkSession, folder: str, source=orders_as_costs) -> DataFrame:
    """The same with each row's place in the order of days and services."""
    filled = gap_fill(rollup(source(spark, folder), "svc", "day"))
    return numbered(materialize(by_place(filled), "svc_day"), PLACE)


def _series(scope: str) -> Query:
    return _placed if scope == "global" else _filled


def _gap_fill(mode: str) -> Query:
    return lambda spark, folder: _fixed(_filled(spark, folder, mode=mode))


def _ewm(name: str, span: int) -> Query:
    return lambda spark, folder: _fixed(
        ewm(_filled(spark, folder), "USD", {name: span}, ["SERVICE"], "STARTDATE").drop("USD")
    )


def _macd(sign: str) -> Query:
    return lambda spark, folder: _fixed(
        macd(_filled(spark, folder), sign=sign).select("SERVICE", "STARTDATE", MACD)
    )


def _signal(scope: str) -> Query:
    return lambda spark, folder: _fixed(
        signal(macd(_series(scope)(spark, folder)), scope=scope).select("SERVICE", "STARTDATE", SIGNAL)
    )


def _cross(scope: str, source=orders_as_costs) -> Query:
    return lambda spark, folder: cross_flag(
        trend_lines(_series(scope)(spark, folder, source), signal_scope=scope)
    ).select("SERVICE", "STARTDATE", "crossFlag")


def trend_testing(spark: SparkSession, folder: str) -> DataFrame:
    return _fixed(trend_series(trend_lines(_placed(spark, folder))))


# -- alerts, summaries, charts, messages ----------------------------------------


def _alerts(spark: SparkSession, folder: str, source, cfg: JobConfig) -> daily_job.Alerts:
    return daily_job.Alerts(source(spark, folder), cfg)


RUNS = {
    "": (orders_as_costs, ORDERS_RUN),
    "_strict": (orders_as_costs, STRICT_RUN),
    "_events": (events_as_costs, EVENTS_RUN),
    "_lineitem": (lineitem_as_costs, LINEITEM_RUN),
}
SUMMARY_RUNS = {k: run for k, run in RUNS.items() if k != "_strict"}


def _alert_frame(frame: str, source, cfg: JobConfig) -> Query:
    return lambda spark, folder: _fixed(getattr(_alerts(spark, folder, source, cfg), frame))


def _daily_spend(source) -> Query:
    return lambda spark, folder: _fixed(daily_spend(source(spark, folder)))


def _mtd(source, cfg: JobConfig) -> Query:
    return lambda spark, folder: _fixed(
        daily_job.summaries(source(spark, folder), cfg).total_by_service
    )


def _daily_by_service(source, cfg: JobConfig) -> Query:
    return lambda spark, folder: _fixed(
        daily_job.summaries(source(spark, folder), cfg).daily_by_service
    )


def total_by_service_all(spark: SparkSession, folder: str) -> DataFrame:
    return _fixed(mtd_by_service(daily_spend(lineitem_as_costs(spark, folder))))


def daily_by_service_all(spark: SparkSession, folder: str) -> DataFrame:
    return _fixed(daily_by_service(daily_spend(lineitem_as_costs(spark, folder))))


def _enriched(source, cfg: JobConfig) -> Query:
    return lambda spark, folder: _fixed(daily_job.enriched(source(spark, folder), cfg))


def _series_macd(source, cfg: JobConfig) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        found = _alerts(spark, folder, source, cfg)
        return _fixed(series.macd_series(found.trend_testing, found.trend_alerts, cfg.as_of))

    return query


def _series_spike(source, cfg: JobConfig) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        found = _alerts(spark, folder, source, cfg)
        return _fixed(
            series.spike_series(
                found.svc_day, found.svc_spike_alerts, cfg.as_of, cfg.z_in, cfg.chart_rows
            )
        )

    return query


def _series_summary(source, cfg: JobConfig) -> Query:
    return lambda spark, folder: _fixed(
        series.summary_series(daily_job.summaries(source(spark, folder), cfg), cfg.as_of)
    )


def top_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The highest service-tag scores of all days; 999 is the report's length."""
    scores = zscore(
        rollup(events_as_costs(spark, folder), "svc_tag", "day"), ["SERVICE", "TAG"], TAG_SCORE
    )
    rounded = scores.select("SERVICE", "TAG", "STARTDATE", F.round(TAG_SCORE, 6).alias(TAG_SCORE))
    ties = F.concat_ws("|", "SERVICE", "TAG", F.col("STARTDATE").cast("string"))
    return messages.top_alerts(rounded, TAG_SCORE, 999, ties)


def _message_rows(source, cfg: JobConfig) -> Query:
    return lambda spark, folder: daily_job.message_rows(
        spark, _alerts(spark, folder, source, cfg), cfg
    )


def _message_blocks(source, cfg: JobConfig) -> Query:
    return lambda spark, folder: messages.to_blocks(
        _message_rows(source, cfg)(spark, folder), "https://charts.example"
    )


def message_text(spark: SparkSession, folder: str) -> DataFrame:
    return messages.message_text(
        _message_blocks(orders_as_costs, ORDERS_RUN)(spark, folder)
    )


def message_payload(spark: SparkSession, folder: str) -> DataFrame:
    """The nested payload in parts of three links, with each label's links as text."""
    nested = messages.to_payload(_message_rows(orders_as_costs, STRICT_RUN)(spark, folder), 3)
    return nested.select("section", "part_no", F.explode("labels").alias("label", "links")).select(
        "section",
        "part_no",
        "label",
        F.array_join(
            F.transform("links", lambda e: F.concat(F.get(e["text"], F.lit(0)), F.lit("|"), e["link"])),
            ";",
        ).alias("links"),
    )


def message_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The message with all tag spikes, in numbered parts of seven blocks."""
    blocks = _message_blocks(orders_as_costs, STRICT_RUN)(spark, folder)
    return messages.message_pages(blocks, 7)


def date_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Alert rows that carry the date instead of the service."""
    found = _alerts(spark, folder, orders_as_costs, ORDERS_RUN).svc_spike_alerts
    return messages.alert_rows(
        found, SVC_SCORE, 3, "spikes", "up", "down", ORDERS_RUN.z_in, -ORDERS_RUN.z_in,
        SPIKE_PREFIX, ORDERS_RUN.as_of, label_kind="date",
    )


def stored_charts(spark: SparkSession, folder: str) -> DataFrame:
    """The spike charts written, and read back."""
    cfg = LINEITEM_RUN
    charts = _series_spike(lineitem_as_costs, cfg)(spark, folder)
    path = new_path(spark, "charts")
    sinks.write_series(charts, path, cfg.as_of)
    return sinks.read_of_day(spark, path, cfg.as_of, charts.schema)


def _run_twice(spark: SparkSession, folder: str, dates: int = 2) -> str:
    """All events landed as pages; runs of the last days. The folder of the outputs."""
    base = new_path(spark, "run")
    _land(events_as_costs(spark, folder), f"{base}/pages")
    for back in reversed(range(dates)):
        daily_job.run(spark, replace(
            EVENTS_RUN, run_date=EVENTS_RUN.run_date - timedelta(days=back), overlap_days=29 - back,
            landing_path=f"{base}/pages", fact_path=f"{base}/fact", output_path=f"{base}/out",
        ))
    return f"{base}/out"


def daily_run_events(spark: SparkSession, folder: str) -> DataFrame:
    """A whole run: all events landed as pages, loaded, alerted on and reported."""
    out = _run_twice(spark, folder, 1)
    return sinks.read_of_day(spark, f"{out}/message_rows", EVENTS_RUN.as_of, messages.MESSAGE_ROWS)


def daily_runs_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of two days that keep the cube and moments; the messages of the second."""
    base = new_path(spark, "run")
    _land(events_as_costs(spark, folder), f"{base}/pages")
    for back in (1, 0):
        daily_job.run(spark, replace(
            EVENTS_RUN, run_date=EVENTS_RUN.run_date - timedelta(days=back), overlap_days=28 if back else 1,
            landing_path=f"{base}/pages", fact_path=f"{base}/fact", output_path=f"{base}/out",
            state_path=f"{base}/state", message_tag_spikes=True,
        ))
    return sinks.read_of_day(spark, f"{base}/out/message_rows", EVENTS_RUN.as_of, messages.MESSAGE_ROWS)


def two_runs_events(spark: SparkSession, folder: str) -> DataFrame:
    """Messages, charts and alerts of two runs, all read back after the second: for each
    table and processed day the number of rows, and the links that have a chart."""
    out = _run_twice(spark, folder)
    tables = [
        "total_by_service", "daily_by_service", "trend_alerts", "svc_spike_alerts",
        "tag_spike_alerts", "charts/trend", "charts/spike", "charts/summary", "message_rows",
    ]
    counts = [
        spark.read.parquet(f"{out}/{name}").groupBy("as_of").agg(F.count(F.lit(1)).alias("records"))
        .select(F.lit(name).alias("name"), "as_of", "records")
        for name in tables
    ]
    links = spark.read.parquet(f"{out}/message_rows").select("link", "as_of")
    charts = [spark.read.parquet(f"{out}/{n}").select("chart_id") for n in tables if "charts/" in n]
    known = reduce(DataFrame.unionByName, charts).distinct()
    linked = links.join(known, links.link == known.chart_id).groupBy("as_of").agg(
        F.count(F.lit(1)).alias("records")
    )
    counts.append(linked.select(F.lit("links with a chart").alias("name"), "as_of", "records"))
    return reduce(DataFrame.unionByName, counts)


def _one_run(spark: SparkSession, folder: str, name: str) -> str:
    """All events landed as pages and one run with every output; the path of one of them."""
    base = new_path(spark, "run")
    _land(events_as_costs(spark, folder), f"{base}/pages")
    daily_job.run(spark, replace(
        EVENTS_RUN, overlap_days=29, base_url="https://charts.example", write_enriched=True,
        landing_path=f"{base}/pages", fact_path=f"{base}/fact", output_path=f"{base}/out",
    ))
    return f"{base}/out/{name}"


def stored_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The messages of a run as posted, with their channel."""
    path = _one_run(spark, folder, "messages")
    return sinks.read_messages(spark, path, EVENTS_RUN.as_of)


def stored_enriched(spark: SparkSession, folder: str) -> DataFrame:
    """The enriched fact that a run has written."""
    path = _one_run(spark, folder, "enriched_fact")
    return _fixed(spark.read.parquet(path).drop("as_of"))


def stored_enriched_order(spark: SparkSession, folder: str) -> DataFrame:
    """Where the rows of each key lie in the stored enriched fact: first and last place."""
    path = _one_run(spark, folder, "enriched_fact")
    keys = spark.read.parquet(path).select("SERVICE", "TAG", "STARTDATE").schema
    placed = sinks.read_in_order(spark, path, EVENTS_RUN.as_of, keys)
    return placed.groupBy("SERVICE", "TAG", "STARTDATE").agg(
        F.min("place").alias("first_place"), F.max("place").alias("last_place")
    )


def stored_alert_order(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every row in the stored alerts and summaries of a run."""
    out = _one_run(spark, folder, "")
    keys = {
        "svc_spike_alerts": "SERVICE string", "tag_spike_alerts": "SERVICE string, TAG string",
        "total_by_service": "SERVICE string", "daily_by_service": "DATE_STR string, SERVICE string",
    }
    found = [
        sinks.read_in_order(spark, f"{out}{name}", EVENTS_RUN.as_of, kind).select(
            F.lit(name).alias("name"), F.concat_ws("|", *[c.split()[0] for c in kind.split(", ")]).alias("key"),
            "place",
        )
        for name, kind in keys.items()
    ]
    return reduce(DataFrame.unionByName, found)


def spikes_flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Services whose spend on a day is at least one deviation above their year."""
    return _alert_frame("svc_spike_alerts", orders_as_costs, SMOKE_RUN)(spark, folder)


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        "cost_fact": cost_fact,
        "date_parts": date_parts,
        "year_week": year_week_keys,
        "date_key": date_keys,
        "tag_clean": tag_clean,
        "amount_round2": amount_round2,
        "lookback_window": lookback,
        "month_to_date": month_filter,
        "low_value_keys": low_value_tags,
        "low_value_totals": low_value_totals,
        "flatten_cost_pages": flatten_cost_pages,
        "pages_mixed_forms": pages_mixed_forms,
        "rejected_pages": rejected_pages,
        "rejected_amounts": rejected_amounts,
        "missing_days": missing_days,
        "overlap_load": overlap_load,
        "export_headers": export_headers,
        "calendar_days": calendar,
        "compact_distinct": compact_distinct,
        "compact_latest": compact_latest,
        "stored_merge": stored_merge,
        "overwrite_existing": overwrite_existing,
        "append_after_merge": append_after_merge,
        "interleaved_writers": interleaved_writers,
        "stored_messages": stored_messages,
        "stored_enriched": stored_enriched,
        "stored_enriched_order": stored_enriched_order,
        "stored_alert_order": stored_alert_order,
        "daily_cube": cube,
        "rollup_svc_week_iso": rollup_svc_week_iso,
        "zscore_svc_day_filled": zscore_svc_day_filled,
        "zscore_svc_day_exact": zscore_svc_day_exact,
        "gap_fill_global": _gap_fill("global"),
        "gap_fill_per_service": _gap_fill("per_service"),
        "ewm12": _ewm(FAST, 12),
        "ewm26": _ewm(SLOW, 26),
        "macd": _macd("slow_minus_fast"),
        "macd_standard": _macd("standard"),
        "signal_global": _signal("global"),
        "signal_service": _signal("service"),
        "cross_flag": _cross("global"),
        "cross_flag_service": _cross("service"),
        "cross_flag_lineitem": _cross("global", lineitem_as_costs),
        "trend_testing": trend_testing,
        "total_by_service": total_by_service_all,
        "daily_by_service_all": daily_by_service_all,
        "enriched_fact": _enriched(orders_as_costs, WHOLE_RUN),
        "enriched_fact_events": _enriched(events_as_costs, EVENTS_RUN),
        "spike_alerts_svc_gaps": _alert_frame("svc_spike_alerts", orders_as_costs, GAP_RUN),
        "top_alerts": top_alerts,
        "stored_charts": stored_charts,
        "spike_alerts_tag_kept": spike_alerts_tag_kept,
        "daily_runs_kept": daily_runs_kept,
        "daily_run_events": daily_run_events,
        "two_runs_events": two_runs_events,
        "message_pages": message_pages,
        "date_labels": date_labels,
        "series_spike_365": _series_spike(lineitem_as_costs, replace(LINEITEM_RUN, chart_rows=365)),
        "message_text": message_text,
        "message_payload": message_payload,
    }
    for level in LEVELS:
        for suffix, (source, split, cfg) in KEPT.items():
            named[f"moments_kept_{level}{suffix}"] = _moments_kept(source, split, cfg, level)
    for level, grain in LEVEL_GRAINS:
        for suffix, source in SOURCES.items():
            named[f"rollup_{level}_{grain}{suffix}"] = _rollup(source, level, grain)
            named[f"moments_{level}_{grain}{suffix}"] = _moments(source, level, grain)
            named[f"zscore_{level}_{grain}{suffix}"] = _zscore(source, level, grain)
    for suffix, (source, cfg) in RUNS.items():
        named[f"trend_alerts{suffix}"] = _alert_frame("trend_alerts", source, cfg)
        named[f"spike_alerts_svc{suffix}"] = _alert_frame("svc_spike_alerts", source, cfg)
        named[f"spike_alerts_tag{suffix}"] = _alert_frame("tag_spike_alerts", source, cfg)
        named[f"series_macd{suffix}"] = _series_macd(source, cfg)
        named[f"series_spike{suffix}"] = _series_spike(source, cfg)
        named[f"message_rows{suffix}"] = _message_rows(source, cfg)
        named[f"message_blocks{suffix}"] = _message_blocks(source, cfg)
    for suffix, (source, cfg) in SUMMARY_RUNS.items():
        named[f"daily_spend{suffix}"] = _daily_spend(source)
        named[f"mtd_by_service{suffix}"] = _mtd(source, cfg)
        named[f"daily_by_service{suffix}"] = _daily_by_service(source, cfg)
        named[f"series_summary{suffix}"] = _series_summary(source, cfg)
    return named
