"""Exact deduplication with a heavy-hitter split, in DataFrame operations only.

A frequent-items sketch (Misra-Gries counters, merged from all tasks) proposes the
digests that many rows share. They are counted exactly, and those verified winners, at
most ``HEAVY`` rows, are broadcast: their copies are settled where they are read and
never shuffled. All other digests, each with few rows, meet in an ordinary shuffle.

Defined results: a null text counts as an empty one; a null id sorts below every other
id; of rows with the same text and the same largest id one stays; an empty table gives
an empty result; columns other than the id and the text are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendtide.llm.texts import lower_ascii
from spendtide.plans.materialize import materialize

#: Digests that may be broadcast, of 64 characters each, and counters of a sketch. A
#: group of more than about 4 / COUNTERS of all rows is always among the proposals.
HEAVY, COUNTERS = 1024, 65536


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased, as lower-case hexadecimal digits."""
    return F.sha2(lower_ascii(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def heavy_digests(digests: DataFrame) -> DataFrame:
    """Exact group figures of the digests that the sketch proposes, ``HEAVY`` at most."""
    sketch = F.expr(f"approx_top_k(digest, {HEAVY}, {COUNTERS})")
    proposed = digests.agg(sketch.alias("top")).select(F.inline("top").alias("digest", "_"))
    return (
        digests.join(F.broadcast(proposed.select("digest")), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
    )


def settle(digests: DataFrame) -> DataFrame:
    """``digests`` (id, digest), stored, with keep_id, group_size and kept of each row."""
    heavy = materialize(heavy_digests(digests), "heavy-digests")
    marked = digests.join(F.broadcast(heavy), "digest", "left")
    copies = marked.where("group_size is not null and not (id <=> keep_id)")
    copies = copies.withColumn("kept", F.lit(False))

    # The winners themselves. An id may be repeated, then one of its rows stays.
    winners = (
        marked.where("group_size is not null and id <=> keep_id")
        .groupBy("id", "digest", "keep_id", "group_size")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("n", F.explode(F.sequence(F.lit(1), "n")))
        .select("id", "digest", "keep_id", "group_size", (F.col("n") == 1).alias("kept"))
    )

    group = Window.partitionBy("digest")
    rest = digests.join(F.broadcast(heavy), "digest", "left_anti").select(
        "id", "digest",
        F.max("id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
        (F.row_number().over(group.orderBy(F.desc_nulls_last("id"))) == 1).alias("kept"),
    )
    return rest.unionByName(copies).unionByName(winners)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``, dropped ones too: id, keep_id, group_size, kept and
    text_sha256. Of equal texts the row with the largest id stays."""
    digests = materialize(
        docs.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest")),
        "digests",
    )
    return settle(digests).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept",
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were.

    Copies of a heavy text go before the shuffle. Of the other rows each task sends at
    most one for a digest, as Spark limits the row number on both sides of the shuffle.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("id"),
        text_digest(F.col(text_col)).alias("digest"),
    )
    heavy = materialize(
        heavy_digests(materialize(rows.select("id", "digest"), "digests")), "heavy-digests"
    )
    best = Window.partitionBy("digest").orderBy(F.desc_nulls_last("id"))
    return (
        rows.join(F.broadcast(heavy), "digest", "left")
        .where("group_size is null or id <=> keep_id")
        .withColumn("n", F.row_number().over(best))
        .where("n = 1")
        .select("row.*")
    )
