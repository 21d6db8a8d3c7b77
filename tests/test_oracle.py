"""Every registered query against its SQL, over whole tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_DIR)
    assert result["ok"] is not False, result


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
