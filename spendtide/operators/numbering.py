"""Numbers along a global order, without a global sort in one task.

Rows are dealt by ranges of the order, sorted in their range and numbered there; the ranges'
sizes, one row each, give the offsets. A number counts only together with the sizes it was
counted with, so the dealt rows must be stored between the two steps.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendtide.plans.materialize import materialize

AT = "_at"
#: Where ``monotonically_increasing_id`` keeps the partition: above the row's number in it.
_ROW_BITS = 33


def dealt(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` by ranges of ``order``, each row with its range and number there in ``AT``.

    Rows that are equal in ``order`` share a range, so it should end in a column that
    tells them apart where there may be many.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.withColumn(AT, F.monotonically_increasing_id())


def numbered(stored: DataFrame, out: str) -> DataFrame:
    """The stored rows of ``dealt`` with their place in the order, from 0.

    The ranges are counted at once: a number for each, as many as the shuffle has
    partitions.
    """
    placed = stored.withColumn("_range", F.shiftright(AT, _ROW_BITS))
    sizes = sorted(placed.groupBy("_range").count().collect())
    before = accumulate((size for _, size in sizes), initial=0)
    offsets = [(which, offset) for (which, _), offset in zip(sizes, before)]
    offsets = stored.sparkSession.createDataFrame(offsets, "_range long, _offset long")
    place = F.col("_offset") + F.col(AT).bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        placed.join(F.broadcast(offsets), "_range")
        .withColumn(out, place)
        .drop("_range", AT, "_offset")
    )


def number_rows(df: DataFrame, order: Sequence[Column | str], out: str, keep=materialize) -> DataFrame:
    """Both steps, with ``df`` stored by ``keep`` in between."""
    return numbered(keep(dealt(df, order), "dealt"), out)
