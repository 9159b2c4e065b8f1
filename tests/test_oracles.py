"""Every named query against its SQL, on the smallest tables."""

from functools import cache

import pytest

from __spark_entry__ import entry
from compare import difference, tables

from spendtide.plans.catalog import queries
from spendtide.plans.oracles import oracle_sql

FOLDER = "/root/testdata/sf0.001"


@cache
def _connection():
    return tables(FOLDER)


def test_every_query_has_sql():
    assert queries().keys() == oracle_sql().keys()


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, name):
    assert difference(queries()[name](spark, FOLDER), _connection(), oracle_sql()[name]) is None


def test_entry(spark):
    found = entry(spark).collect()
    assert [r.SERVICE for r in found] == ["1-URGENT"]
    assert found[0].svc_day_zscore == pytest.approx(1.6980, abs=5e-5)
