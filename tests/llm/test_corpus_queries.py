"""Corpus queries against their SQL, and the pipeline's contract, on the smallest tables."""

import corpus_pipeline
import pytest
from compare import difference, tables

from spendtide.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = list(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    found = queries.queries()[name](spark, FOLDER)
    assert difference(found, tables(FOLDER), queries.oracle_sql()[name]) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, none, FOLDER).isEmpty(), name
        assert stage(spark, none, FOLDER).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, none, FOLDER).isEmpty()
