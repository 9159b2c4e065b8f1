"""URL lists with dates, joined to captures as they stood at fetch time.

A list is a log of dated entries: from ``at`` on, the domain ``rule`` has the ``action``
(block, allow, ... or NULL: no entry any more). Entries of a rule become validity
intervals, each open to its end, where the rule's next entry begins. A capture is subject
to the rules of its host and of every parent domain; the as-of join finds, for each of
them, the interval that holds the fetch time, and the longest domain with an action in
force decides.

Captures meet intervals by rule and day: a rule's day holds the intervals that begin on it
and the one that is open at its start, which a running last value along the rule's days
carries in. So a capture is compared with the entries of one day of each of its domains,
however long the list of a domain is, and a frequent domain has a key for each day, which
Spark splits further. Only domains that have entries are joined, and one partial maximum
per capture picks the verdict. A capture has as many candidate domains as its host has
labels.

Defined results: of entries of a rule at the same time the one with the greatest action
counts, NULL below all others; rules are compared without letter case and outer dots;
entries without a rule or time are never in force; captures without a url, a host or a
fetch time get no verdict but a row; null and repeated ids keep a row each; empty tables
give no verdicts; extra columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendtide.plans.materialize import materialize


def host(url: Column) -> Column:
    """The lower-case host of a url, without user, port and outer dots; NULL without one."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.trim(F.lower(found), F.lit(".")), F.lit(""))


def domains(name: Column) -> Column:
    """The host and all its parent domains, longest first."""
    labels = F.split(name, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )


def intervals(entries: DataFrame) -> DataFrame:
    """(rule, action, since, until) of the entries (rule, action, at); until may be NULL."""
    rule = F.nullif(F.trim(F.lower("rule"), F.lit(".")), F.lit(""))
    one = (
        entries.select(rule.alias("rule"), "action", F.col("at").cast("timestamp").alias("since"))
        .where("rule is not null and since is not null")
        .groupBy("rule", "since")
        .agg(F.max("action").alias("action"))
    )
    until = F.lead("since").over(Window.partitionBy("rule").orderBy("since"))
    return one.withColumn("until", until).where("action is not null")


def by_day(held: DataFrame, keys: DataFrame) -> DataFrame:
    """(rule, day, list): the intervals that any day of ``keys`` (rule, day) or of the
    intervals can ask for, in order of time."""
    interval = F.struct("since", "until", "action")
    own = held.groupBy("rule", F.to_date("since").alias("day")).agg(
        F.sort_array(F.collect_list(interval)).alias("own"), F.max(interval).alias("last")
    )
    asked = keys.select("rule", "day").distinct().withColumns({
        "own": F.lit(None).cast(own.schema["own"].dataType),
        "last": F.lit(None).cast(own.schema["last"].dataType),
    })
    days = own.unionByName(asked).groupBy("rule", "day").agg(
        F.any_value("own", True).alias("own"), F.any_value("last", True).alias("last")
    )
    earlier = Window.partitionBy("rule").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last("last", ignorenulls=True).over(earlier)
    none = F.array().cast(own.schema["own"].dataType)
    return days.withColumn("carried", carried).select(
        "rule", "day",
        F.concat(
            F.when(F.col("carried").isNotNull(), F.array("carried")).otherwise(none),
            F.coalesce("own", none),
        ).alias("list"),
    )


def verdicts(
    captures: DataFrame, entries: DataFrame,
    id_col: str = "page_id", url_col: str = "url", at_col: str = "fetched_at",
) -> DataFrame:
    """One row per capture: id, url, host, fetch time, and the rule, action and start of
    the entry that decides (NULL: none does)."""
    rows = captures.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.col(url_col).alias("url"), F.col(at_col).cast("timestamp").alias("fetched_at"),
    ).withColumn("host", host(F.col("url")))
    rows = materialize(rows, "captures")
    held = materialize(intervals(entries), "intervals")
    keys = (
        rows.where("host is not null and fetched_at is not null")
        .select("row", "fetched_at", F.explode(domains(F.col("host"))).alias("rule"))
        .join(held.select("rule").distinct(), "rule", "left_semi")
        .withColumn("day", F.to_date("fetched_at"))
    )
    keys = materialize(keys, "capture-domains")
    active = F.filter(
        "list",
        lambda i: (i["since"] <= F.col("fetched_at"))
        & (i["until"].isNull() | (F.col("fetched_at") < i["until"])),
    )
    in_force = (
        keys.join(by_day(held, keys), ["rule", "day"])
        .withColumn("entry", F.get(active, F.lit(0)))
        .where("entry is not null")
        .select("row", "rule", "entry.action", "entry.since")
    )
    best = in_force.groupBy("row").agg(
        F.max(F.struct(F.length("rule").alias("size"), "rule", "action", "since")).alias("best")
    )
    return rows.join(best, "row", "left").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "host",
        F.col("fetched_at").alias(at_col), "best.rule", "best.action", "best.since",
    )
