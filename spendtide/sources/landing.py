"""Landed billing pages to typed cost rows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from spendtide.functions.dates import add_date_parts
from spendtide.functions.numbers import amount
from spendtide.functions.text import clean_tag
from spendtide.schema import COST_EXTRACT, COST_FACT, COST_METRIC, RAW_PAGES

# Headers of the older export and the names used here.
EXPORT_HEADERS = {
    "Dimension/Tag": "SERVICE",
    "Dimension/Tag.1": "TAG",
    "Metric": "METRIC",
    "Granularity": "GRANULARITY",
    "Start": "STARTDATE",
    "End": "ENDDATE",
    "USD Amount": "USD",
    "Unit": "UNIT",
}


_PAGE = T.StructType([*RAW_PAGES.fields, T.StructField("_corrupt", T.StringType())])

# A string of JSON cannot run over a line's end, so every line begins outside of one.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_TOKENS = f'{_STRING}|[^"]+|"'
_BETWEEN_PAGES = r"\}\s*\{"
#: A line that opens a page, by the key that only pages have, and one that may with the next.
_KEY = r'^\s*"(ResultsByTime|NextPageToken)"\s*:'
_OPENS, _BRACE = r'^\s*\{\s*"(ResultsByTime|NextPageToken)"\s*:', r"^\s*\{\s*$"
#: Bytes of a file after which a page without an end is cut; Spark rows hold less than twice as much.
PAGE_BYTES = 1 << 30
#: A part of a block has 2 ** 10 lines at most: a window keeps 4,096 rows as they are, more are spilled.
PART_BITS = 10


def text_lines(reader: DataFrameReader | DataStreamReader, path: str) -> DataFrame:
    """Lines of all files under ``path`` with the file and the block they come from."""
    return reader.text(path).select(
        "*", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def with_place(lines: DataFrame) -> DataFrame:
    """(file, at, value) of ``text_lines``; ``at`` orders the lines of a file."""
    return lines.select(
        "file", F.struct("block", F.monotonically_increasing_id().alias("line")).alias("at"), "value"
    )


def _parsed(raw: DataFrame) -> DataFrame:
    """(file, raw) with the page, and the reason where ``raw`` is none."""
    page = F.from_json("raw", _PAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    raw = raw.withColumn("page", page)
    broken = F.col("page").isNull() | F.col("page._corrupt").isNotNull()
    reason = F.when(broken, "malformed page").when(
        F.col("page.ResultsByTime").isNull(), "no results in page"
    )
    return raw.withColumn("reason", reason)


def _pieces(lines: DataFrame) -> DataFrame:
    """(file, block, part, at, piece) of lines, cut between pages, and the braces that each piece
    opens more than it closes; what stands in strings does not count. A part of a block has
    up to 2 ** ``PART_BITS`` lines."""
    token = F.regexp_extract_all("value", F.lit(_TOKENS), F.lit(0))
    cut = F.transform(
        token, lambda t: F.when(t.rlike('^".+'), t).otherwise(F.regexp_replace(t, _BETWEEN_PAGES, "}\n{"))
    )
    cut = F.when(
        F.col("value").rlike(_BETWEEN_PAGES), F.split(F.array_join(cut, ""), "\n")
    ).otherwise(F.array("value"))
    bare = F.regexp_replace("piece", _STRING, "")

    def count(sign: str) -> Column:
        return F.length(bare) - F.length(F.replace(bare, F.lit(sign), F.lit("")))

    return (
        lines.select("file", "at.block", "at.line", F.posexplode(cut).alias("n", "piece"))
        .where(F.trim("piece") != "")
        .select(
            "file", "block", F.shiftright("line", PART_BITS).alias("part"),
            F.struct("line", "n").alias("at"), "piece", (count("{") - count("}")).alias("opened"),
        )
    )


def _pages_over_lines(lines: DataFrame) -> DataFrame:
    """(file, raw) of the pages that run over several lines or share one.

    A page begins where no brace is open, or at a page's own key, so that one that was cut
    off ends there. Open braces are counted along each part of a block of a file; what a
    part begins with comes from the sums of the parts before it, one row each. Pieces of a
    page meet in one group, which holds nothing else, those of a part as one text. Windows
    over lines hold a part, so that only the sort before them takes memory by the block.
    """
    place = ["file", "block", "part"]
    along = Window.partitionBy(*place).orderBy("at")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_along = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    in_file = Window.partitionBy("file").orderBy("block", "part")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)

    piece = F.col("piece")
    brace, key = piece.rlike(_BRACE), piece.rlike(_KEY)
    pieces = _pieces(lines).withColumns({
        "before": F.sum("opened").over(so_far) - F.col("opened"),
        "own_key": piece.rlike(_OPENS) | (brace & F.coalesce(F.lead(key).over(along), F.lit(False))),
        "ends": F.lead("at").over(along).isNull(),
    })
    ends = pieces.groupBy(*place).agg(
        F.sum("opened").alias("opened"), F.min("before").alias("lowest"),
        F.max_by("before", F.when(F.col("own_key"), F.col("at"))).alias("page_at"),
        F.max_by("before", "at").alias("end_at"),
        F.max_by(brace, "at").alias("brace"), F.min_by(key, "at").alias("key"),
    )
    # A brace at a part's end opens a page if the next part begins with a page's key.
    opens = F.col("brace") & F.coalesce(F.lead("key").over(in_file), F.lit(False))
    offsets = ends.withColumns({
        "offset": F.coalesce(F.sum("opened").over(earlier), F.lit(0)), "opens": opens,
    }).withColumn("page_at", F.when(F.col("opens"), F.col("end_at")).otherwise(F.col("page_at")))
    base = F.last(F.col("offset") + F.col("page_at"), ignorenulls=True).over(earlier)
    offsets = offsets.withColumn("base", F.coalesce(base, F.lit(0)))
    # What a part has before its first start belongs to the last start of an earlier part,
    # which is named by its part alone.
    has_start = F.col("page_at").isNotNull() | (F.col("offset") + F.col("lowest") <= F.col("base"))
    at = F.lit(None).cast(pieces.schema["at"].dataType)
    last_start = F.when(has_start, F.struct("block", "part", at.alias("start")))
    offsets = offsets.select(
        *place, "opens", (F.col("offset") - F.col("base")).alias("open"),
        F.last(last_start, ignorenulls=True).over(earlier).alias("owner"),
    )
    since = F.last(F.when(F.col("own_key"), F.col("before")), ignorenulls=True).over(so_far)
    depth = F.col("before") - F.coalesce(F.col("since"), -F.col("open"))
    start = F.when(F.col("starts"), F.col("at"))
    # A hash join leaves the pieces in their order; its one row for each part is small.
    pieces = (
        pieces.join(offsets.hint("shuffle_hash"), place)
        .withColumn("own_key", F.col("own_key") | (F.col("opens") & F.col("ends")))
        .withColumn("since", since)
        .withColumn("starts", F.col("own_key") | (depth <= 0))
        .withColumns({
            "start": F.last(start, ignorenulls=True).over(so_far),
            "last_start": F.last(start, ignorenulls=True).over(all_along),
        })
    )
    inner = F.when(F.col("start") != F.col("last_start"), F.col("start")).alias("start")
    page = F.when(F.col("start").isNotNull(), F.struct("block", "part", inner)).otherwise(F.col("owner"))
    parts = pieces.withColumn("page", page).groupBy(*place, "page").agg(
        F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces")
    ).select(*place, "page", F.array_join(F.col("pieces.piece"), "\n").alias("text"))
    long = F.floor((F.col("block") - F.coalesce(F.col("page.block"), F.lit(0))) / PAGE_BYTES)
    texts = F.sort_array(F.collect_list(F.struct("block", "part", "text")))
    return parts.groupBy("file", "page", long).agg(texts.alias("texts")).select(
        "file", F.array_join(F.col("texts.text"), "\n").alias("raw")
    )


def parse_pages(lines: DataFrame) -> DataFrame:
    """One row per page of ``with_place`` lines: its fields, file, and reason and raw text where
    it cannot be read.

    A file may have one page on a line, several on a line, pages over many lines, or all
    of these. A line that can only be one page is read as such, where it stands; all
    others are cut into pages by their braces. Whether there are others is looked up
    first, so pages on lines take one plain scan.
    """
    line = F.trim("value")
    one_page = (
        line.startswith("{") & line.endswith("}") & line.contains('"ResultsByTime"')
        & ~line.rlike(_BETWEEN_PAGES)
    )
    alone = lines.where(one_page).select("file", line.alias("raw"))
    rest = lines.where(~one_page & (line != ""))
    found = _parsed(alone)
    if not rest.isEmpty():
        found = found.unionByName(_parsed(_pages_over_lines(rest)))
    return found.select(
        "file", "reason", F.when(F.col("reason").isNotNull(), F.col("raw")).alias("raw"),
        *[F.when(F.col("reason").isNull(), F.col(f"page.{n}")).alias(n) for n in RAW_PAGES.names],
    )


def read_cost_pages(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """All landed pages under ``path``, whatever their layout; see ``parse_pages``.

    They may lie in ``day=yyyy-MM-dd`` folders, of which only those from ``first`` to
    ``last`` are opened then.
    """
    lines = _within(text_lines(spark.read, path), "day", first, last)
    return parse_pages(with_place(lines))


def overlap_window(as_of: date, days: int = 7, end_inclusive: bool = True) -> tuple[date, date]:
    """First and last day to load: ``days`` back, with or without ``as_of`` itself."""
    return as_of - timedelta(days=days), as_of if end_inclusive else as_of - timedelta(days=1)


def expected_days(spark: SparkSession, first: date, last: date) -> DataFrame:
    """Every day a load must cover."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("STARTDATE")
    )


def _each_day() -> Column:
    """The days of a page as ``d``, NULL for a page without: an inner explode would make
    Spark ask below it whether there are any, by parsing every page once more."""
    return F.explode_outer("ResultsByTime").alias("d")


def landed_days(pages: DataFrame) -> DataFrame:
    """The days that the pages report on, those without spend as well."""
    return pages.select(_each_day()).select(
        F.to_date("d.TimePeriod.Start", "yyyy-MM-dd").alias("STARTDATE")
    ).where("STARTDATE is not null").distinct()


def missing_days(pages: DataFrame, first: date, last: date) -> DataFrame:
    """Days from ``first`` to ``last`` that no page reports on."""
    wanted = expected_days(pages.sparkSession, first, last)
    return wanted.join(landed_days(pages), "STARTDATE", "left_anti")


def flatten_cost_pages(pages: DataFrame, double_strip_tag: bool = False) -> DataFrame:
    """One row per group of each day: the eight extracted columns.

    A day spans from its start to the next day. Groups without the cost metric have a
    NULL amount here, and are rejected later.
    """
    groups = pages.select(_each_day()).select(
        F.to_date("d.TimePeriod.Start", "yyyy-MM-dd").alias("STARTDATE"),
        F.explode("d.Groups").alias("g"),
    )
    return groups.select(
        F.try_element_at("g.Keys", F.lit(1)).alias("SERVICE"),
        clean_tag(F.try_element_at("g.Keys", F.lit(2)), double_strip_tag).alias("TAG"),
        F.lit(COST_METRIC).alias("METRIC"),
        F.lit("DAILY").alias("GRANULARITY"),
        "STARTDATE",
        F.date_add("STARTDATE", 1).alias("ENDDATE"),
        F.try_element_at("g.Metrics", F.lit(COST_METRIC))["Amount"].alias("USD"),
        F.lit("USD").alias("UNIT"),
    )


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename the headers of the older export; other names stay."""
    return df.withColumnsRenamed(EXPORT_HEADERS)


def to_fact(extract: DataFrame, exact: bool = False) -> DataFrame:
    """Extracted columns to the fact: dates and amounts typed, date parts added."""
    typed = extract.select(
        *[
            amount(F.col(f.name), exact).alias("USD") if f.name == "USD"
            else F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
            for f in COST_EXTRACT
        ]
    )
    return add_date_parts(typed).select(*COST_FACT.names)


def _reason(exact: bool) -> Column:
    """Why an extracted row cannot become a fact row; NULL where it can."""
    return (
        F.when(F.col("STARTDATE").isNull(), "no readable day")
        .when(F.col("USD").isNull(), "no amount")
        .when(amount(F.col("USD"), exact).isNull(), "unreadable amount")
    )


def rejected(pages: DataFrame, double_strip_tag: bool = False, exact: bool = False) -> DataFrame:
    """What a load cannot read: (file, reason, raw) of pages and of rows in them."""
    days = pages.select("file", _each_day()).where("d is not null")
    rows = flatten_cost_pages(pages, double_strip_tag).where(_reason(exact).isNotNull())
    return (
        pages.where("reason is not null").select("file", "reason", "raw")
        .unionByName(rows.select(
            F.lit(None).cast("string").alias("file"), _reason(exact).alias("reason"),
            F.to_json(F.struct(*rows.columns)).alias("raw"),
        ))
        .unionByName(days.where("d.Groups is null").select(
            "file", F.lit("no groups").alias("reason"), F.to_json("d").alias("raw"),
        ))
    )


def landed_costs(
    pages: DataFrame, first: date | None = None, last: date | None = None,
    double_strip_tag: bool = False, exact: bool = False,
) -> DataFrame:
    """Fact rows of the landed pages, limited to ``first`` to ``last`` where given.

    Rows that cannot be read are in ``rejected``, never in the fact as an amount of 0.
    """
    flat = normalize_columns(flatten_cost_pages(pages, double_strip_tag))
    return _within(to_fact(flat.where(_reason(exact).isNull()), exact), "STARTDATE", first, last)


def _within(df: DataFrame, day: str, first: date | None, last: date | None) -> DataFrame:
    """Rows from ``first`` to ``last`` by the column ``day``, if there is one."""
    if day in df.columns and first is not None:
        df = df.where(F.col(day) >= F.lit(first))
    if day in df.columns and last is not None:
        df = df.where(F.col(day) <= F.lit(last))
    return df
