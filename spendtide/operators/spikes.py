"""Days whose standard score reaches the cut-off."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendtide.functions.dates import add_date_parts
from spendtide.operators.moment_states import score_by
from spendtide.operators.stats import zscore

# Output column names.
SVC_SCORE, TAG_SCORE = "svc_day_zscore", "svc_tag_day_zscore"


def service_scores(svc_day: DataFrame) -> DataFrame:
    """Score of every service and day."""
    scored = add_date_parts(zscore(svc_day, ["SERVICE"], SVC_SCORE, order="STARTDATE"))
    return scored.select(
        "STARTDATE", "SERVICE", "YEAR", "MONTH", "DAY", SVC_SCORE,
        F.col("STARTDATE").alias("date"),
    )


def tag_scores(svc_tag_day: DataFrame) -> DataFrame:
    """Score of every service, tag and day with data."""
    return _tag_columns(zscore(svc_tag_day, ["SERVICE", "TAG"], TAG_SCORE, order="STARTDATE"))


def tag_scores_by(states: DataFrame, svc_tag_day: DataFrame) -> DataFrame:
    """The same for some days of a series whose ``states`` are known."""
    return _tag_columns(score_by(states, svc_tag_day, ["SERVICE", "TAG"], TAG_SCORE))


def _tag_columns(scored: DataFrame) -> DataFrame:
    return add_date_parts(scored).select(
        "SERVICE", "TAG", "YEAR", "MONTH", "DAY", TAG_SCORE, F.col("STARTDATE").alias("date")
    )


def detect_spikes(
    scores: DataFrame, score: str, as_of: date, z_in: float = 1.0, two_sided: bool = False
) -> DataFrame:
    """Scores on ``as_of`` that are at least ``z_in`` (or at most its negative)."""
    high = F.col(score) >= F.lit(float(z_in))
    hit = high | (F.col(score) <= F.lit(-float(z_in))) if two_sided else high
    return scores.where((F.col("date") == F.lit(as_of)) & hit)
