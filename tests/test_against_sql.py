"""Every named query against its SQL on the same whole tables."""

import os

import pytest

from telmart.plans import oracle, registry
from tests.compare import duck, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = registry.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, connection, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(connection, SQL[name])
    assert columns == expected_columns
    assert sum(rows.values()) > 0
    assert rows == expected
