"""Connected components of a link table, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendtide.plans.materialize import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long): the smallest node it reaches.

    Each round gives a node the smallest label among its neighbours, then the label of
    its label, so paths shorten by more than half a round. A node with very many links
    is no hot group: its smallest label is found by partial minima, and both joins are
    plain sort-merge joins, which Spark splits where a key is skewed. Every round is
    written to the shared work folder.
    """
    links = materialize(links.where("a <> b").select("a", "b"), "links")
    both = links.unionByName(links.selectExpr("b as a", "a as b"))
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        .select("node", F.least("node", "b").alias("root")),
        "labels",
    )
    while True:
        offered = both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), "root")
        nearest = materialize(
            labels.select("node", "root", F.col("root").alias("was"))
            .unionByName(offered.withColumn("was", F.lit(None).cast("long")))
            .groupBy("node")
            .agg(F.min("root").alias("root"), F.max("was").alias("was")),
            "labels",
        )
        if nearest.where("root < was").isEmpty():
            return nearest.select("node", "root")
        up = nearest.select(F.col("node").alias("root"), F.col("root").alias("above"))
        labels = materialize(
            nearest.select("node", "root").join(up, "root").select("node", F.col("above").alias("root")),
            "labels",
        )
