"""The daily run: load, summarise, alert, chart series, messages."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendtide.config import JobConfig
from spendtide.functions.dates import lookback_window, months_back
from spendtide.operators import messages, series
from spendtide.operators.enrich import service_stats, tag_stats, with_stats
from spendtide.operators.gapfill import gap_fill
from spendtide.operators.numbering import numbered
from spendtide.operators.rollups import daily_cube, rollup
from spendtide.operators.spikes import (
    SVC_SCORE, TAG_SCORE, detect_spikes, service_scores, tag_scores, tag_scores_by,
)
from spendtide.operators.summary import Summary, summarize
from spendtide.operators.suppress import anti_suppress, low_value_keys, tagged
from spendtide.operators.trend import (
    PLACE, by_place, detect_crossings, trend_lines, trend_series,
)
from spendtide.plans.kept import KeptState
from spendtide.plans.materialize import materialize, work_folder
from spendtide.sources import facts, landing, sinks


def load_costs(spark: SparkSession, cfg: JobConfig) -> None:
    """Merge the landed pages of the overlap window into the fact table.

    What cannot be read is stored under ``rejected_path`` (by default beside the fact),
    by processed day. More than ``reject_tolerance`` such records, or a day of the window
    that no page reports on, stop the load before the fact is touched.
    """
    first, last = landing.overlap_window(cfg.as_of, cfg.overlap_days, cfg.end_inclusive)
    pages = materialize(landing.read_cost_pages(spark, cfg.landing_path, first, last), "pages")
    bad = landing.rejected(pages, cfg.double_strip_tag, cfg.exact_amounts)
    path = cfg.rejected_path or f"{cfg.fact_path.rstrip('/')}-rejected"
    sinks.write_of_day(bad, path, cfg.as_of)
    count = sinks.read_of_day(spark, path, cfg.as_of, bad.schema).count()
    if count > cfg.reject_tolerance:
        raise ValueError(f"{count} landed records cannot be read; see {path}")
    if cfg.require_all_days:
        missing = [r.STARTDATE for r in landing.missing_days(pages, first, last).collect()]
        if missing:
            raise ValueError(f"no page reports on {', '.join(map(str, sorted(missing)))}")
    batch = landing.landed_costs(pages, first, last, cfg.double_strip_tag, cfg.exact_amounts)
    facts.merge_fact(batch, cfg.fact_path, first, last, cfg.compact)


Keep = Callable[[DataFrame, str], DataFrame]


def lazily(df: DataFrame, name: str) -> DataFrame:
    """A ``Keep`` that stores nothing."""
    return df


class Alerts:
    """Series and alerts of one day, from the fact or its daily cube.

    Each frame is built when first asked for. Those that feed several others pass
    through ``keep``, by default a stored table: they have one row per service and
    day, while computing them again would mean reading the fact again.
    """

    def __init__(
        self, costs: DataFrame, cfg: JobConfig, keep: Keep = materialize,
        tag_states: DataFrame | None = None,
    ) -> None:
        """``tag_states`` are the moments of each service and tag over the whole window,
        where they are known; then only the day itself is rolled up by tag."""
        self._window = lookback_window(costs, cfg.as_of, cfg.lookback_months)
        self._tag_states = tag_states
        self._cfg = cfg
        self._keep = keep

    @cached_property
    def _stored_days(self) -> DataFrame:
        sums = rollup(self._window, "svc", "day")
        if self._cfg.gap_fill == "per_service":
            # The first and last day are read apart from the series.
            sums = self._keep(sums, "svc_sums")
        filled = gap_fill(sums, self._cfg.gap_fill)
        # The store that the series needs anyway gives the places of a global signal line.
        return self._keep(by_place(filled) if self._cfg.signal_scope == "global" else filled, "svc_day")

    @cached_property
    def svc_day(self) -> DataFrame:
        """Gap-filled daily spend per service."""
        return self._stored_days.select("SERVICE", "STARTDATE", "USD")

    @cached_property
    def lines(self) -> DataFrame:
        """``svc_day`` with means, MACD and signal."""
        cfg = self._cfg
        days = self.svc_day
        if cfg.signal_scope == "global":
            days = numbered(self._stored_days, PLACE)
        lines = trend_lines(
            days, cfg.fast_span, cfg.slow_span, cfg.signal_span, cfg.signal_scope,
            cfg.macd_sign,
        )
        return self._keep(lines, "lines")

    @cached_property
    def trend_testing(self) -> DataFrame:
        return trend_series(self.lines)

    @cached_property
    def trend_alerts(self) -> DataFrame:
        return self._without_low(detect_crossings(self.trend_testing, self._cfg.as_of))

    @cached_property
    def svc_spike_testing(self) -> DataFrame:
        return service_scores(self.svc_day)

    @cached_property
    def svc_spike_alerts(self) -> DataFrame:
        return self._without_low(self._spikes(self.svc_spike_testing, SVC_SCORE))

    @cached_property
    def tag_spike_testing(self) -> DataFrame:
        return tag_scores(rollup(self._window, "svc_tag", "day"))

    @cached_property
    def tag_spike_alerts(self) -> DataFrame:
        keys = ("SERVICE", "TAG")
        scores = self.tag_spike_testing
        if self._tag_states is not None:
            day = self._window.where(F.col("STARTDATE") == F.lit(self._cfg.as_of))
            scores = tag_scores_by(self._tag_states, rollup(day, "svc_tag", "day"))
        found = anti_suppress(self._spikes(scores, TAG_SCORE), self._low(*keys), keys)
        return tagged(found, self._cfg.drop_empty_tag)

    def _spikes(self, scores: DataFrame, score: str) -> DataFrame:
        return detect_spikes(
            scores, score, self._cfg.as_of, self._cfg.z_in, self._cfg.two_sided
        )

    def _low(self, *keys: str) -> DataFrame:
        # Reads one day only: the date filter prunes the scan.
        cfg = self._cfg
        return low_value_keys(self._window, cfg.as_of, cfg.low_value_floor, keys, cfg.suppress_on)

    def _without_low(self, found: DataFrame) -> DataFrame:
        return anti_suppress(found, self._low("SERVICE"), ["SERVICE"]).drop("STARTDATE")


def enrich(
    fact: DataFrame,
    cube: DataFrame,
    lines: DataFrame,
    iso_year: bool = False,
    keep: Keep = materialize,
) -> DataFrame:
    """The fact with all statistics, given its stored cube and trend lines."""
    of_services = keep(service_stats(cube, lines, iso_year), "service_stats")
    of_tags = keep(tag_stats(cube, iso_year), "tag_stats")
    return with_stats(fact, of_services, of_tags, iso_year)


def enriched(fact: DataFrame, cfg: JobConfig, keep: Keep = materialize) -> DataFrame:
    """The trailing window of the fact with all statistics, in two reads of it."""
    window = lookback_window(fact, cfg.as_of, cfg.lookback_months)
    cube = keep(daily_cube(window), "daily_cube")
    return enrich(window, cube, Alerts(cube, cfg, keep).lines, cfg.iso_year, keep)


def summaries(costs: DataFrame, cfg: JobConfig) -> Summary:
    return summarize(costs, cfg.as_of, cfg.summary_month, cfg.lookback_months)


def message_rows(spark: SparkSession, found: Alerts, cfg: JobConfig) -> DataFrame:
    return messages.build_messages(
        spark, found.trend_alerts, found.svc_spike_alerts, cfg.as_of, cfg.z_in, cfg.top_n,
        found.tag_spike_alerts if cfg.message_tag_spikes else None,
    )


@dataclass(frozen=True)
class RunResult:
    summary: Summary
    alerts: Alerts
    message_rows: DataFrame
    message: DataFrame


def run(spark: SparkSession, cfg: JobConfig) -> RunResult:
    """One daily run. The fact is read once, into the materialised daily cube.

    With ``state_path`` the cube and the tags' monthly moments are kept there from run to
    run, and only the days that changed since the last run are read from the fact.

    Outputs are written under ``output_path`` where it is set; delivery of the
    message table is left to whatever watches it.
    """
    if cfg.load_data and cfg.landing_path:
        load_costs(spark, cfg)
    keep = partial(materialize, folder=work_folder(spark))
    since = months_back(cfg.as_of, cfg.lookback_months)
    tag_states = None
    if cfg.state_path:
        kept = KeptState(spark, cfg.fact_path, cfg.state_path, cfg.exact_amounts)
        kept.refreshed_months("svc_tag")
        cube = kept.cube.read(since, cfg.as_of)
        tag_states = kept.states("svc_tag", since, cfg.as_of)
    else:
        fact = facts.read_fact(spark, cfg.fact_path, since, cfg.as_of, cfg.exact_amounts)
        # Ordered by day, so that reads of a month or a day skip row groups.
        cube = keep(daily_cube(fact).sortWithinPartitions("STARTDATE"), "daily_cube")

    summary = summaries(cube, cfg)
    found = Alerts(cube, cfg, keep, tag_states)
    rows = message_rows(spark, found, cfg)
    message = messages.message_pages(messages.to_blocks(rows, cfg.base_url))

    if cfg.output_path:
        write_outputs(spark, cfg, RunResult(summary, found, rows, message))
    return RunResult(summary, found, rows, message)


def write_outputs(spark: SparkSession, cfg: JobConfig, result: RunResult) -> None:
    """All tables of a run, each in the processed day's folder of its own table.

    A repeated run replaces its own day; other days keep their charts and messages.
    """
    found, summary = result.alerts, result.summary
    write = partial(sinks.write_of_day, as_of=cfg.as_of)
    out = cfg.output_path
    write(summary.total_by_service, f"{out}/total_by_service", order=["SERVICE"])
    write(summary.daily_by_service, f"{out}/daily_by_service", order=["DATE_STR", "SERVICE"])
    write(found.trend_alerts, f"{out}/trend_alerts", order=["SERVICE"])
    write(found.svc_spike_alerts, f"{out}/svc_spike_alerts", order=["SERVICE"])
    write(found.tag_spike_alerts, f"{out}/tag_spike_alerts", order=["SERVICE", "TAG"])
    charts = {
        "trend": series.macd_series(found.trend_testing, found.trend_alerts, cfg.as_of),
        "spike": series.spike_series(
            found.svc_day, found.svc_spike_alerts, cfg.as_of, cfg.z_in, cfg.chart_rows
        ),
        "summary": series.summary_series(summary, cfg.as_of),
    }
    for kind, chart in charts.items():
        sinks.write_series(chart, f"{out}/charts/{kind}", cfg.as_of)
    if cfg.write_enriched:
        fact = facts.read_fact(spark, cfg.fact_path, exact=cfg.exact_amounts)
        write(enriched(fact, cfg), f"{out}/enriched_fact", order=["SERVICE", "TAG", "STARTDATE"])
    write(result.message_rows, f"{out}/message_rows", order=["section_no", "label_no", "rank"])
    sinks.write_messages(result.message, f"{out}/messages", cfg.channel, cfg.as_of)
