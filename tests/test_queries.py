"""Every registered query against its SQL at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from suite.check import connect, normal

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The corpus queries have tests of their own, in tests/llm.
CORPUS = {n for n in entry.queries() if n == "pipeline" or n.startswith("op") and n[2:3].isdigit()}
NAMES = [n for n in entry.queries() if n not in CORPUS]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert not set(NAMES) - set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    mine = entry.queries()[name](spark, SF).toPandas()
    theirs = con.sql(entry.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert normal(mine) == normal(theirs)


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "text"]
