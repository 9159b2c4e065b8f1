"""Intermediate results as tables, so that a lost executor costs no rescan."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession) -> str:
    """The shared folder that the session names in ``spark.checkpoint.dir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return shared


def name_work_folder(spark: SparkSession) -> None:
    """Name a folder beside the warehouse's tables where the session has none.

    A warehouse on a machine's own disk will do only where all tasks run on that machine.
    """
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        one_machine = spark.sparkContext.master.split("[")[0] == "local"
        if warehouse.startswith(("file:", "/")) and not one_machine:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        spark.sparkContext.setCheckpointDir(f"{warehouse}/_work")


def new_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A path under the work folder that nothing else uses."""
    return f"{(folder or work_folder(spark)).rstrip('/')}/{name}-{uuid4().hex}"


def materialize(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as parquet and read it back, with a lineage of one scan."""
    spark = df.sparkSession
    path = new_path(spark, name, folder)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
