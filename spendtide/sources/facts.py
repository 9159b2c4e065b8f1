"""The cost fact table: a table by day (see ``day_table``) of overlapping loads."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendtide.functions.numbers import EXACT
from spendtide.schema import cost_fact
from spendtide.sources.day_table import DayTable, within

PARTITION = "STARTDATE"
KEYS = ("SERVICE", "TAG", "STARTDATE")


def fact_table(spark: SparkSession, path: str, exact: bool = False) -> DayTable:
    """The table at ``path``; ``exact`` tells the kind of its amounts."""
    return DayTable(spark, path, cost_fact(exact), PARTITION, ("SERVICE", "TAG"))


def _table_of(df: DataFrame, path: str) -> DayTable:
    return fact_table(df.sparkSession, path, df.schema["USD"].dataType == EXACT)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(version, action, part, STARTDATE, rows): what each commit holds of each day."""
    return fact_table(spark, path).commits()


def read_fact(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None,
    exact: bool = False,
) -> DataFrame:
    """The fact, or its days from ``first`` to ``last``, as a partition-pruned scan."""
    return fact_table(spark, path, exact).read(first, last)


def append_fact(df: DataFrame, path: str, writer: str | None = None, batch: int | None = None) -> bool:
    """Add rows; a ``writer``'s numbered batch is added once only."""
    return _table_of(df, path).append(df, writer, batch)


def overwrite_fact(df: DataFrame, path: str) -> None:
    """Replace the whole table; ``df`` may read from it."""
    _table_of(df, path).overwrite(df)


def replace_days(
    spark: SparkSession, path: str, first: date, last: date,
    content: Callable[[DataFrame], DataFrame], exact: bool = False,
) -> None:
    """Put ``content`` of the days from ``first`` to ``last`` in their place."""
    fact_table(spark, path, exact).replace_days(first, last, content)


def drop_old_versions(spark: SparkSession, path: str, min_age_seconds: int = 0) -> None:
    """Delete what no reader needs any more; see ``DayTable.drop_unread``."""
    fact_table(spark, path).drop_unread(min_age_seconds)


def merged(history: DataFrame, batch: DataFrame, compact: str = "distinct") -> DataFrame:
    """Union of both without repeated rows.

    ``distinct`` drops equal rows only, so a restated amount stands beside the old
    one. ``latest`` lets the batch replace every (SERVICE, TAG, STARTDATE) it has.
    """
    if compact == "latest":
        fresh = batch.select(*[F.col(k).alias(f"new_{k}") for k in KEYS]).distinct()
        same = (
            F.col("SERVICE").eqNullSafe(F.col("new_SERVICE"))
            & F.col("TAG").eqNullSafe(F.col("new_TAG"))
            & (F.col("STARTDATE") == F.col("new_STARTDATE"))
        )
        history = history.join(fresh, same, "left_anti")
    return history.unionByName(batch).distinct()


def compact_fact(
    spark: SparkSession, path: str, first: date, last: date, exact: bool = False
) -> None:
    """Drop repeated rows of the table's days from ``first`` to ``last``."""
    replace_days(spark, path, first, last, DataFrame.distinct, exact)


def merge_fact(
    batch: DataFrame, path: str, first: date, last: date, compact: str = "distinct"
) -> None:
    """Append an overlapping load and drop repeats, rewriting only its days.

    Running it again with the same batch changes nothing.
    """
    batch = within(batch, PARTITION, first, last)
    _table_of(batch, path).replace_days(first, last, lambda history: merged(history, batch, compact))
