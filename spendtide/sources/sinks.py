"""Output tables of a run, one folder per processed day in each."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _folder(path: str, as_of: date) -> str:
    return f"{path.rstrip('/')}/as_of={as_of:%Y-%m-%d}"


def write_of_day(df: DataFrame, path: str, as_of: date, order: Sequence[str] = ()) -> None:
    """A result table of one processed day, in the given row order."""
    df = df.orderBy(*order) if order else df
    df.write.mode("overwrite").parquet(_folder(path, as_of))


def read_of_day(spark: SparkSession, path: str, as_of: date, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(_folder(path, as_of))


def read_in_order(
    spark: SparkSession, path: str, as_of: date, schema: T.StructType | str, out: str = "place"
) -> DataFrame:
    """A result table of one processed day with each row's place in it, from 0.

    An ordered table's files are ordered by name; a place is the rows of the files before,
    one row per file, and the row's own index.
    """
    found = spark.read.schema(schema).parquet(_folder(path, as_of)).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_index")
    )
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = found.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return (
        found.join(F.broadcast(offsets), "_file")
        .withColumn(out, F.col("_before") + F.col("_index"))
        .drop("_file", "_index", "_before")
    )


def write_series(df: DataFrame, path: str, as_of: date) -> None:
    """Chart series of one processed day, clustered by chart: a chart is found by the row
    groups' statistics, and many small charts share a file."""
    (
        df.repartitionByRange("chart_id", "DATE")
        .sortWithinPartitions("chart_id", "DATE")
        .write.mode("overwrite")
        .parquet(_folder(path, as_of))
    )


#: Of a message as posted.
MESSAGES = "message_no int, blocks string, channel string"


def read_messages(spark: SparkSession, path: str, as_of: date) -> DataFrame:
    return spark.read.schema(MESSAGES).json(_folder(path, as_of))


def write_messages(messages: DataFrame, path: str, channel: str, as_of: date) -> None:
    """Messages with the channel they are meant for, as JSON lines."""
    messages.withColumn("channel", F.lit(channel)).write.mode("overwrite").json(
        _folder(path, as_of)
    )
