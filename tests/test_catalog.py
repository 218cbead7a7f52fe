"""Every registered query against its SQL, on the smallest tables."""

import __spark_entry__ as spark_entry
import pytest
from catalog import oracles, queries

from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES = queries.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR)
    assert result.startswith("ok"), result


def test_entry(spark):
    assert spark_entry.entry(spark).columns[0] == "column"
