"""Newly landed pages to an append-only table, each file exactly once.

The table is an input of the daily merge like any other batch; repeats from
overlapping loads are dropped there, not in the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from spendtide.sources.facts import append_fact
from spendtide.sources.landing import (
    landed_costs, parse_pages, rejected, text_lines, with_place,
)


def append_landed(
    spark: SparkSession,
    landing_path: str,
    table_path: str,
    checkpoint_path: str,
    double_strip_tag: bool = False,
    rejected_path: str | None = None,
) -> StreamingQuery:
    """Append the pages that arrived since the last call, then stop.

    Each batch of files is one commit of the table; a repeated batch is known by its number
    and adds nothing. What cannot be read goes to ``rejected_path`` (by default beside the
    table), in a folder for each batch.
    """
    rejected_path = rejected_path or f"{table_path.rstrip('/')}-rejected"

    def load(lines: DataFrame, batch: int) -> None:
        pages = parse_pages(with_place(lines))
        costs = landed_costs(pages, double_strip_tag=double_strip_tag)
        # A new checkpoint has a new id, and its batches are others.
        query = lines.sparkSession.read.text(f"{checkpoint_path.rstrip('/')}/metadata").first().value
        append_fact(costs, table_path, query, batch)
        rejected(pages, double_strip_tag).write.mode("overwrite").parquet(
            f"{rejected_path}/landed_batch={batch}"
        )

    return (
        text_lines(spark.readStream, landing_path)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
