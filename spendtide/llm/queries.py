"""One query per corpus operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendtide.llm import (
    decontaminate,
    exact_dedup,
    filter_audit,
    html_blocks,
    importance,
    license_scan,
    oracles,
    quality,
    sentencepieces,
    simhash,
    substring_dedup,
    token_counts,
    url_filter,
    warc,
)
from spendtide.plans.materialize import materialize, new_path


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepieces.encode(_documents(spark, folder), check=True)


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, folder))


def op3_html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return html_blocks.extract(spark.read.parquet(f"{folder}/pages.parquet"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return quality.classify(_documents(spark, folder), labels)


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontaminate.matches(_documents(spark, folder), benchmark)
    similarity = F.round(1 - F.col("edits") / F.col("item_words"), 6)
    return found.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "edits", "item_words",
        similarity.alias("similarity"), "last_word",
    )


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All documents under two tokenizer versions, then without their copies, then with
    word counts revised to words with a letter or digit; the second batch comes twice."""
    return _token_totals(spark, _documents(spark, folder))


def _token_totals(spark: SparkSession, docs: DataFrame) -> DataFrame:
    text = F.col("text")
    lettered = F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: w.rlike(r"[\p{L}\p{Nd}]"))
    rows = docs.select(
        "doc_id", "source", "lang", "text", token_counts.word_count(text).alias("words"),
        F.coalesce(F.size(lettered), F.lit(0)).cast("long").alias("lettered"),
        exact_dedup.text_digest(text).alias("digest"),
    )
    # One pass over the texts. The stored number tells rows apart that are equal otherwise.
    names = ("doc_id", "source", "lang", "words", "lettered", "digest")
    counts = sentencepieces.encode(rows, keep={n: n for n in names}, ids=False)
    counts = materialize(counts.withColumn("row", F.monotonically_increasing_id()), "counts")
    # Of equal texts the row with the largest id stays, of rows with that id the last one.
    digests = materialize(counts.select(F.struct("doc_id", "row").alias("id"), "digest"), "row-digests")
    kept = exact_dedup.settle(digests).select(F.col("id.row").alias("row"), "kept")
    counts = counts.join(kept, "row")

    def of(version: str, tokens: str, rows: DataFrame = counts) -> DataFrame:
        return rows.select(
            "source", "lang", "kept", F.lit(version).alias("version"), F.col(tokens).cast("long").alias("tokens")
        )

    both = of("words", "words").unionByName(of("pieces", "n_pieces"))
    left = counts.where("kept").select(
        "source", "lang", F.lit("words").alias("version"), F.col("words").alias("old_tokens"),
        F.col("lettered").alias("new_tokens"),
    )
    rollup = token_counts.Rollup(spark, new_path(spark, "token-totals"))
    rollup.apply("insert", token_counts.inserts(both))
    for _ in range(2):
        rollup.apply("copies", token_counts.deletes(both.where("not kept")))
    rollup.apply("lettered", token_counts.revisions(left))
    return rollup.totals()


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, folder))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_passages(_documents(spark, folder)).drop("check")


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_scan(_documents(spark, folder))


def _dated(text: Column) -> Column:
    """A second of the year 2024 that the text's MD5 names."""
    seconds = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % 31_536_000
    return F.timestamp_seconds(F.lit(1_704_067_200) + seconds)


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's url against a list that has three dated entries for each domain of the
    pages; times and actions come from MD5."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    captures = pages.withColumn("fetched_at", _dated(F.col("url")))
    names = pages.select(F.explode(url_filter.domains(url_filter.host(F.col("url")))).alias("rule"))
    entry = names.distinct().withColumn("n", F.explode(F.array(*map(F.lit, range(3)))))
    seed = F.concat_ws("#", "rule", "n")
    digit = F.conv(F.substring(F.md5(seed.cast("binary")), 9, 1), 16, 10).cast("int")
    action = F.when(digit < 5, "block").when(digit < 9, "allow")
    entries = entry.select("rule", action.alias("action"), _dated(seed).alias("at"))
    found = url_filter.verdicts(captures, entries)
    return found.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("fetched_at", "since")}
    )


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.filter_audit(
        _documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    )


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(spark.read.parquet(f"{folder}/pages.parquet"))


def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return importance.importance_sample(_documents(spark, folder), benchmark)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
