"""Numeric expressions that never yield NaN where a value is undefined."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round2(value: Column) -> Column:
    """Two decimals, halves of the scaled value to even (0.575 gives 0.57)."""
    return F.rint(value * 100) / 100


def without_nan(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


#: Amounts whose sums do not depend on the order of the rows.
EXACT = T.DecimalType(28, 12)


def amount(text: Column, exact: bool = False) -> Column:
    """Amount text to double, or to ``EXACT``; unreadable text and NaN become NULL."""
    return text.try_cast(EXACT) if exact else without_nan(text.try_cast("double"))


def total(value: str) -> Column:
    """Sum that is 0 for a group without values, of the kind that sums of ``value`` are."""
    return F.coalesce(F.sum(value), F.lit(0))


def zscore_over(value: Column, window: WindowSpec, scored: Column | None = None) -> Column:
    """Standard score with the sample deviation, NULL for constant groups.

    ``scored`` is what gets the score where that is not ``value`` itself, the base of
    mean and deviation. Constancy is tested on the values, since rounding noise in the
    deviation of equal values would give a huge score. NaN must not appear: Spark
    orders it above every number, so an undefined score would pass a ``>=`` filter.
    """
    varies = F.max(value).over(window) > F.min(value).over(window)
    spread = F.nullif(F.stddev_samp(value).over(window), F.lit(0.0))
    scored = value if scored is None else scored
    return F.when(varies, without_nan((scored - F.avg(value).over(window)) / spread))
