"""A training corpus from raw documents, in five stages.

Each stage reads what its predecessor kept and returns the columns of ``documents``; the
last adds the piece numbers. Tables beside the documents (labels, benchmark) come from
``sf_dir``. Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendtide.llm import decontaminate, exact_dedup, quality, sentencepieces, simhash
from spendtide.plans.materialize import materialize, name_work_folder


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (a score of 0.3 or more)."""
    return quality.drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (fingerprints of three-word shingles that
    differ in three bits at most), the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns of the documents, their piece numbers, how many, and whether they
    decode to the text."""
    return sentencepieces.encode(docs, keep={c: c for c in docs.columns}, check=True)


STAGES = [
    ("quality", quality_filter),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("sentencepiece", piece_ids),
]

#: Not for SQL: trained scores, fingerprints with reachability, edit distances, Viterbi.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written as parquet and read again."""
    name_work_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
