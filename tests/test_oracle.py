"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return duck(SF_DIR)


def test_names_fit():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    sql = entry.oracle_sql().get(name)
    if sql is None:
        entry.queries()[name](spark, SF_DIR).collect()
    else:
        assert compare(con, entry.queries()[name], sql, spark, SF_DIR) == ""
