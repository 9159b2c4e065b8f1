"""Text expressions: tags and chart names."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# The tag prefix and the name formats that messages and charts share.
TAG_PREFIX = "Name$"
TREND_PREFIX = "amz_"
SPIKE_PREFIX = "amz_tot_"
TAG_SPIKE_PREFIX = "amz_tag_"
MONTH_CHART = "amz_mtdSpendxService"
DAILY_CHART = "amz_dailySpendxService"


def clean_tag(tag: Column, double_strip: bool = False) -> Column:
    """Remove the tag prefix; ``double_strip`` also cuts five more characters."""
    bare = F.replace(tag, F.lit(TAG_PREFIX), F.lit(""))
    return F.substring(bare, len(TAG_PREFIX) + 1, 2**31 - 1) if double_strip else bare


def without_blanks(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def chart_key(service: Column) -> Column:
    """The service without blanks. Of services that then have the same name, all but the
    first get a mark of their own; a window over the frame's rows finds them."""
    bare = without_blanks(service)
    first = F.min(service).over(Window.partitionBy(bare))
    marked = F.concat(bare, F.lit("-"), F.substring(F.md5(service.cast("binary")), 1, 8))
    return F.when(service == first, bare).otherwise(marked)


def chart_name(prefix: str, service: Column, as_of: date) -> Column:
    return F.concat(F.lit(prefix), without_blanks(service), F.lit(f"_{as_of:%Y%m%d}"))


def chart_title(service: Column, region: Column | None = None, title: str | None = None) -> Column:
    """The given title, else "service (region)", else the service."""
    if title is not None:
        return F.lit(title)
    if region is None:
        return service
    return F.coalesce(F.concat(service, F.lit(" ("), region, F.lit(")")), service)
