"""Every query with SQL must give the same whole result as the SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tests.oracle_check import connect, differences

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def engine():
    return connect(FOLDER)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, engine, name):
    ours = contract.queries()[name](spark, FOLDER).toPandas()
    assert differences(ours, engine.execute(SQL[name]).df()) is None


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_entry_runs(spark):
    assert contract.entry(spark).count() == 4
