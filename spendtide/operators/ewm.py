"""Exponentially weighted means as window sums.

With decay b = 1 - 2 / (span + 1) the mean starts at the first value and then
follows y[t] = b * y[t-1] + (1 - b) * x[t]. What it lags behind the value,
e = x - y, follows e[t] = b * (e[t-1] + x[t] - x[t-1]), so

    y[t] = x[t] - b^(t+1) * (sum of (x[k] - x[k-1]) * b^-k for k = 1..t)

which is a running sum: no row waits for another one's result. Unlike a sum of the
values, it is exact where the series rests: a constant series is its own mean, and
means of different spans meet exactly once they have settled, so rounding noise
cannot make their lines cross.

b^-k leaves the double range after a few thousand rows, so a series is cut into blocks
with an exponent origin each. What a block ends with is carried on exactly: the lag at a
row is the block's own lag plus the carried one times its decay since.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

_BLOCK_DECAY = 140 * math.log(10)
#: Blocks after which even the largest double has decayed below the smallest.
_DEEP = 6


def _decay(span: float) -> float:
    if span <= 1:
        raise ValueError("span must be above 1")
    return 1.0 - 2.0 / (span + 1.0)


def block_length(span: float) -> int:
    """Rows after which a value has decayed by 1e-140."""
    return math.ceil(_BLOCK_DECAY / -math.log(_decay(span)))


def _own_lag(step: Column, place: Column, decay: float, window: WindowSpec) -> Column:
    """The lag from the steps along ``window``; ``place`` counts its rows from 0."""
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(step * F.pow(F.lit(decay), -place)).over(running) * F.pow(F.lit(decay), place + 1)


def _after_block(decay: float, out: str) -> Callable[[Column, Column], Column]:
    """The lag at a block's end from the one before the block and the block's own."""
    return lambda lag, end: lag * F.pow(F.lit(decay), end["rows"]) + end[out]


def ewm(
    df: DataFrame, value: str, spans: dict[str, float], keys: Sequence[str], order: str
) -> DataFrame:
    """Add one mean per ``spans`` entry (name to span) along the date ``order`` within ``keys``.

    ``value`` must not be NULL, and a key has one row a day. Blocks are stretches of the
    calendar, so they hold no more rows than days and need no numbering; all windows follow
    the same order of key, block and date, and the series is sorted once. A row sees one
    entry per block before it.
    """
    length = min(map(block_length, spans.values()))
    series = Window.partitionBy(*keys).orderBy("_block", order)
    block = Window.partitionBy(*keys, "_block").orderBy(order)
    before = series.rowsBetween(Window.unboundedPreceding, -1)
    place, x = F.col("_place"), F.col(value)
    df = df.withColumn("_block", F.floor(F.unix_date(order) / length))
    df = df.withColumns({
        "_step": F.coalesce(x - F.lag(value).over(series), F.lit(0.0)),
        "_ends": F.lead("_block").over(series) != F.col("_block"),
        "_place": F.row_number().over(block) - 1,
    })
    df = df.withColumns({
        f"_lag_{out}": _own_lag(F.col("_step"), place, _decay(span), block)
        for out, span in spans.items()
    })
    end = F.struct((place + 1).alias("rows"), *[F.col(f"_lag_{out}").alias(out) for out in spans])
    df = df.withColumn("_before", F.collect_list(F.when(F.col("_ends"), end)).over(before))
    for out, span in spans.items():
        decay = _decay(span)
        carried = F.aggregate("_before", F.lit(0.0), _after_block(decay, out))
        lag = F.col(f"_lag_{out}") + carried * F.pow(F.lit(decay), place + 1)
        df = df.withColumn(out, x - lag)
    return df.drop("_block", "_step", "_ends", "_place", "_before", *[f"_lag_{out}" for out in spans])


def ewm_along(df: DataFrame, value: str, span: float, out: str, position: str) -> DataFrame:
    """Add one mean that runs through all rows in ``position`` order.

    Blocks of bounded length are the partitions, so the rows spread evenly however
    many there are. What is carried into a block comes from the ``_DEEP`` blocks before
    it; an older lag has decayed below the smallest double, so nothing is cut.
    """
    decay, length = _decay(span), block_length(span)
    place, block = F.col(position) % length, Window.partitionBy("_block").orderBy(position)
    step = F.coalesce(F.col(value) - F.lag(value).over(block), F.lit(0.0))
    # Never NULL, so the join below adds no filter to one of the two uses of the rows.
    df = df.withColumn("_block", F.coalesce(F.floor(F.col(position) / length), F.lit(0)))
    df = df.withColumn("_own", step).withColumn("_own", _own_lag(F.col("_own"), place, decay, block))

    # Taking the whole row along keeps this branch's input equal to the rows, so both read
    # one exchange and what comes before it runs once.
    ends = df.groupBy("_block").agg(
        F.max_by(F.struct(*df.columns), position).alias("end"),
        F.min_by(value, position).alias("first"),
    ).select(
        "_block", F.col("end._own").alias("lag"), "first", F.col(f"end.`{value}`").alias("last")
    )
    seen = ends.select(
        F.struct("_block", "lag", "first", "last").alias("end"),
        F.explode(F.sequence(F.col("_block"), F.col("_block") + _DEEP)).alias("_block"),
    )
    start = F.struct(F.lit(0.0).alias("into"), F.lit(0.0).alias("lag"),
                     F.lit(None).cast("double").alias("last"))

    def follow(state: Column, end: Column) -> Column:
        step = F.coalesce(end["first"] - state["last"], F.lit(0.0))
        into = state["into"] * F.lit(decay**length) + state["lag"] + step
        return F.struct(into.alias("into"), end["lag"].alias("lag"), end["last"].alias("last"))

    carried = (
        seen.groupBy("_block").agg(F.sort_array(F.collect_list("end")).alias("ends"))
        .where(F.get(F.reverse("ends"), F.lit(0))["_block"] == F.col("_block"))
        .select("_block", F.aggregate("ends", start, follow)["into"].alias("_into"))
    )
    lag = F.col("_own") + F.col("_into") * F.pow(F.lit(decay), place + 1)
    return df.join(carried, "_block").withColumn(out, F.col(value) - lag).drop(
        "_block", "_own", "_into"
    )
