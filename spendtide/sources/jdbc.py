"""The fact table in a relational database, through Spark's JDBC source."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession


def date_slices(first: date, last: date, slices: int, on: str = "STARTDATE") -> list[str]:
    """Predicates that cut ``first`` to ``last`` (inclusive) into even date ranges."""
    days = (last - first).days + 1
    slices = max(1, min(slices, days))
    edges = [first + timedelta(days=days * i // slices) for i in range(slices + 1)]
    return [
        f"{on} >= DATE '{lo:%Y-%m-%d}' AND {on} < DATE '{hi:%Y-%m-%d}'"
        for lo, hi in zip(edges, edges[1:])
    ]


def read_fact_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    first: date,
    last: date,
    slices: int = 8,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """One task per date slice; further filters and columns are pushed to the database."""
    return spark.read.jdbc(
        url, table, predicates=date_slices(first, last, slices), properties=properties or {}
    )


def write_fact_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    overwrite: bool = False,
    properties: dict[str, str] | None = None,
) -> None:
    df.write.jdbc(url, table, mode="overwrite" if overwrite else "append", properties=properties)
