"""Settings of one daily run."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

_CHOICES = {
    "gap_fill": ("global", "per_service", "none"),
    "compact": ("distinct", "latest"),
    "signal_scope": ("global", "service"),
    "macd_sign": ("slow_minus_fast", "standard"),
    "suppress_on": ("row", "service_total"),
}


@dataclass(frozen=True)
class JobConfig:
    """Everything a run depends on; no operator reads the wall clock itself.

    The second group of fields selects between the established behaviour
    (the default) and a corrected variant of it.
    """

    run_date: date = field(default_factory=date.today)
    month_of: date | None = None
    z_in: float = 1.0
    low_value_floor: float = 0.01
    lookback_months: int = 12
    overlap_days: int = 7
    top_n: int | None = None
    fast_span: int = 12
    slow_span: int = 26
    signal_span: int = 9
    chart_rows: int | None = None
    load_data: bool = True
    public: bool = True
    public_channel: str = "public"
    private_channel: str = "private"
    base_url: str = ""
    landing_path: str | None = None
    rejected_path: str | None = None
    reject_tolerance: int = 0
    require_all_days: bool = True
    fact_path: str | None = None
    output_path: str | None = None
    state_path: str | None = None
    write_enriched: bool = False

    end_inclusive: bool = True
    double_strip_tag: bool = False
    exact_amounts: bool = False
    gap_fill: str = "global"
    compact: str = "distinct"
    iso_year: bool = False
    signal_scope: str = "global"
    macd_sign: str = "slow_minus_fast"
    suppress_on: str = "row"
    drop_empty_tag: bool = False
    two_sided: bool = False
    message_tag_spikes: bool = False

    def __post_init__(self) -> None:
        for name, allowed in _CHOICES.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}")

    @property
    def as_of(self) -> date:
        """The processed day: the one before the run."""
        return self.run_date - timedelta(days=1)

    @property
    def summary_month(self) -> date:
        """Any day of the month the summaries cover; the run date's by default."""
        return self.month_of or self.run_date

    @property
    def channel(self) -> str:
        return self.public_channel if self.public else self.private_channel
