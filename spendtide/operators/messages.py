"""Message rows, the nested payload and the block list made from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendtide.functions.text import (
    DAILY_CHART, MONTH_CHART, SPIKE_PREFIX, TAG_SPIKE_PREFIX, TREND_PREFIX, chart_key,
)
from spendtide.operators.numbering import number_rows
from spendtide.operators.spikes import SVC_SCORE, TAG_SCORE

# Section keys, labels and texts of the message.
SUMMARY_SECTION, SUMMARY_LABEL = "awsSummary", "AWS Services Summary"
TREND_SECTION = "awsTrends"
TREND_UP, TREND_DOWN = "Upward Trending AWS Services", "Downward Trending AWS Services"
SPIKE_SECTION = "awsSvcSpikes"
SPIKE_UP, SPIKE_DOWN = "Spike up in AWS Services", "Spike down in AWS Services"
DAILY_TEXT, MONTH_TEXT = "Daily Spend x Service", "Month to Date Spend x Service"
TAG_SECTION = "awsTagSpikes"
TAG_UP, TAG_DOWN = "Spike up in AWS Service Tags", "Spike down in AWS Service Tags"

MESSAGE_ROWS = T.StructType([
    T.StructField("section_no", T.IntegerType()),
    T.StructField("section", T.StringType()),
    T.StructField("label_no", T.IntegerType()),
    T.StructField("label", T.StringType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("link", T.StringType()),
])


#: Blocks and bytes that one message may have; a longer block has one of its own.
MESSAGE_BLOCKS, MESSAGE_BYTES = 50, 100_000
#: Links that one row of the nested payload may have.
PAYLOAD_LINKS = 1000


def top_alerts(alerts: DataFrame, score: str, n: int, ties: Column | str = "SERVICE") -> DataFrame:
    """The ``n`` alerts with the highest score; ``ties`` makes the choice repeatable."""
    return alerts.orderBy(F.desc_nulls_last(score), ties).limit(n)


def alert_lines(
    alerts: DataFrame,
    score: str,
    section_no: int,
    section: str,
    up_label: str,
    down_label: str,
    high: float,
    low: float,
    prefix: str,
    as_of: date,
    top_n: int | None = None,
    label_kind: str = "service",
    text: Column | None = None,
) -> DataFrame:
    """Lines of one alert section: up at ``high`` or more, down at ``low`` or less.

    Scores between the two are dropped. The text is the service (or ``text``), or the
    alert's date for ``label_kind="date"``, whose link carries no name. All alerts are
    reported, or with ``top_n`` that many of the highest scores.
    """
    stamp = F.lit(f"{as_of:%Y%m%d}")
    if label_kind == "service":
        shown = F.col("SERVICE") if text is None else text
        link = F.concat(F.lit(prefix), chart_key(shown), F.lit("_"), stamp)
    elif label_kind == "date":
        shown = F.date_format("date", "yyyy-MM-dd")
        link = F.concat(F.lit(prefix), stamp)
    else:
        raise ValueError("label_kind must be 'service' or 'date'")

    label_no = F.when(F.col("_score") >= F.lit(high), 1).when(F.col("_score") <= F.lit(low), 2)
    found = alerts.select(F.col(score).alias("_score"), shown.alias("text"), link.alias("link"))
    if top_n is not None:
        found = top_alerts(found, "_score", top_n, "text")
    return (
        found.withColumn("label_no", label_no)
        .where(F.col("label_no").isNotNull())
        .select(
            F.lit(section_no).alias("section_no"),
            F.lit(section).alias("section"),
            "label_no",
            F.when(F.col("label_no") == 1, up_label).otherwise(down_label).alias("label"),
            "text",
            "link",
            "_score",
        )
    )


def ranked(lines: DataFrame) -> DataFrame:
    """Message rows of alert lines, ranked within their label.

    The lines are numbered in message order by ranges, so no task holds a label; the
    labels' first places are a row for each label of a section.
    """
    order = ["section_no", "label_no", F.desc("_score"), "text", "link"]
    placed = number_rows(lines, order, "place")
    label = ["section_no", "label_no"]
    firsts = placed.groupBy(*label).agg(F.min("place").alias("first"))
    rank = (F.col("place") - F.col("first") + 1).cast("int")
    return placed.join(F.broadcast(firsts), label).withColumn("rank", rank).select(*MESSAGE_ROWS.names)


def alert_rows(*arguments, **more) -> DataFrame:
    """Message rows of one alert section; see ``alert_lines``."""
    return ranked(alert_lines(*arguments, **more))


def summary_rows(spark: SparkSession, as_of: date) -> DataFrame:
    """The two links to the summary charts."""
    stamp = f"_{as_of:%Y%m%d}"
    links = [
        (1, DAILY_TEXT, DAILY_CHART + stamp),
        (2, MONTH_TEXT, MONTH_CHART + stamp),
    ]
    rows = [
        F.struct(*[
            F.lit(value).alias(field.name)
            for value, field in zip((1, SUMMARY_SECTION, 1, SUMMARY_LABEL, *link), MESSAGE_ROWS)
        ])
        for link in links
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def trend_lines(alerts: DataFrame, as_of: date, top_n: int | None = None) -> DataFrame:
    return alert_lines(
        alerts, "crossFlag", 2, TREND_SECTION, TREND_UP, TREND_DOWN, 1, -1,
        TREND_PREFIX, as_of, top_n,
    )


def spike_lines(alerts: DataFrame, as_of: date, z_in: float = 1.0, top_n: int | None = None) -> DataFrame:
    return alert_lines(
        alerts, SVC_SCORE, 3, SPIKE_SECTION, SPIKE_UP, SPIKE_DOWN, float(z_in), -float(z_in),
        SPIKE_PREFIX, as_of, top_n,
    )


def tag_spike_lines(alerts: DataFrame, as_of: date, z_in: float = 1.0, top_n: int | None = None) -> DataFrame:
    """Optional section: tag spikes are not part of the usual message."""
    return alert_lines(
        alerts, TAG_SCORE, 4, TAG_SECTION, TAG_UP, TAG_DOWN, float(z_in), -float(z_in),
        TAG_SPIKE_PREFIX, as_of, top_n,
        text=F.concat_ws(" / ", "SERVICE", "TAG"),
    )


def build_messages(
    spark: SparkSession,
    trend_alerts: DataFrame,
    svc_spike_alerts: DataFrame,
    as_of: date,
    z_in: float = 1.0,
    top_n: int | None = None,
    tag_spike_alerts: DataFrame | None = None,
) -> DataFrame:
    """All message rows; a section or label without alerts has none."""
    lines = trend_lines(trend_alerts, as_of, top_n).unionByName(
        spike_lines(svc_spike_alerts, as_of, z_in, top_n)
    )
    if tag_spike_alerts is not None:
        lines = lines.unionByName(tag_spike_lines(tag_spike_alerts, as_of, z_in, top_n))
    return summary_rows(spark, as_of).unionByName(ranked(lines))


def _with_offset(rows: DataFrame, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Add how many rows of earlier ``keys`` there are (of the same ``within``); ``keys``
    are labels, of which there is a handful."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*within).orderBy(*keys) if within else Window.orderBy(*keys)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return rows.join(offsets, list(keys))


def to_payload(rows: DataFrame, links: int = PAYLOAD_LINKS) -> DataFrame:
    """The nested payload: a label-to-links map per section, in numbered parts of ``links``
    links at most."""
    placed = _with_offset(rows, ["section_no", "label_no"], ["section_no"])
    part = (F.floor((F.col("offset") + F.col("rank") - 1) / links) + 1).cast("int")
    found = F.sort_array(F.collect_list(F.struct("rank", "text", "link")))
    labels = placed.groupBy("section_no", "section", part.alias("part_no"), "label_no", "label").agg(
        F.transform(
            found, lambda r: F.struct(F.array(r["text"]).alias("text"), r["link"].alias("link"))
        ).alias("links")
    )
    return labels.groupBy("section_no", "section", "part_no").agg(
        F.map_from_entries(
            F.transform(
                F.sort_array(F.collect_list(F.struct("label_no", "label", "links"))),
                lambda e: F.struct(e["label"], e["links"]),
            )
        ).alias("labels")
    )


def _header_block(label: Column) -> Column:
    text = F.struct(
        F.lit("text").alias("type"),
        F.concat(F.trim(label, F.lit("'")), F.lit(":")).alias("text"),
        F.struct(F.lit(True).alias("bold"), F.lit(True).alias("italic")).alias("style"),
    )
    section = F.struct(F.lit("rich_text_section").alias("type"), F.array(text).alias("elements"))
    return F.to_json(F.struct(F.lit("rich_text").alias("type"), F.array(section).alias("elements")))


def _section_block(text: Column, url: Column) -> Column:
    button = F.struct(
        F.lit("button").alias("type"),
        F.struct(
            F.lit("plain_text").alias("type"),
            F.lit("Plot").alias("text"),
            F.lit(True).alias("emoji"),
        ).alias("text"),
        F.lit("Plot").alias("value"),
        url.alias("url"),
        F.lit("button-action").alias("action_id"),
    )
    body = F.struct(F.lit("mrkdwn").alias("type"), text.alias("text"))
    return F.to_json(
        F.struct(F.lit("section").alias("type"), body.alias("text"), button.alias("accessory"))
    )


def to_blocks(rows: DataFrame, base_url: str = "") -> DataFrame:
    """One JSON block per label (rank 0) and per message row, in message order."""
    url = F.concat(F.lit(f"{base_url}/"), F.col("link"), F.lit(".html"))
    own = F.struct("rank", _section_block(F.col("text"), url).alias("block"))
    header = F.struct(F.lit(0).alias("rank"), _header_block(F.col("label")).alias("block"))
    # A label's first row brings its header along.
    blocks = F.when(F.col("rank") == 1, F.array(header, own)).otherwise(F.array(own))
    return rows.select("section_no", "label_no", F.inline(blocks))


def message_pages(
    blocks: DataFrame, size: int = MESSAGE_BLOCKS, most_bytes: int = MESSAGE_BYTES
) -> DataFrame:
    """The blocks as numbered messages (message_no from 1, blocks) of ``size`` blocks and
    ``most_bytes`` bytes at most; a block that is longer is a message of its own.

    A block's place is its rank within the label behind all blocks of earlier labels, so
    its group is known before anything is collected, and a group holds ``size`` blocks.
    """
    place = F.col("offset") + F.col("rank")
    listed = F.sort_array(F.collect_list(F.struct("place", "block")))
    groups = (
        _with_offset(blocks, ["section_no", "label_no"])
        .select("block", place.alias("place"))
        .groupBy(F.floor(F.col("place") / size).alias("page"))
        .agg(listed.alias("listed"))
        .select("page", F.col("listed.block").alias("listed"))
    )
    # Which part of its group each block goes to, by the bytes before it.
    cuts = F.expr(f"""aggregate(
        transform(listed, b -> octet_length(b) + 1L),
        named_struct('part', 0, 'bytes', 0L, 'parts', cast(array() as array<int>)),
        (a, b) -> if(a.bytes > 0 and a.bytes + b > {most_bytes}L,
            named_struct('part', a.part + 1, 'bytes', b, 'parts', concat(a.parts, array(a.part + 1))),
            named_struct('part', a.part, 'bytes', a.bytes + b, 'parts', concat(a.parts, array(a.part)))),
        a -> a.parts)""")
    groups = groups.withColumn("cuts", cuts).withColumn("last", F.element_at("cuts", -1))
    parts = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("last"))))
    own = F.expr("filter(listed, (b, k) -> cuts[k] = part)")
    texts = parts.select(
        "page", "part", F.concat(F.lit("["), F.array_join(own, ","), F.lit("]")).alias("blocks")
    )
    numbers = number_rows(texts, ["page", "part"], "place")
    return numbers.select((F.col("place") + 1).cast("int").alias("message_no"), "blocks")


def message_text(blocks: DataFrame) -> DataFrame:
    """The blocks as JSON arrays, one for each message; short block lists have one."""
    return message_pages(blocks)
