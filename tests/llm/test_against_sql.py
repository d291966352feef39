"""Every operator that SQL can express against its SQL on whole tables."""

import pytest

from telmart.llm import queries
from tests.compare import duck, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows(spark, name):
    columns, rows = spark_rows(queries.queries()[name](spark, SF_DIR))
    expected_columns, expected = sql_rows(duck(SF_DIR), queries.oracle_sql()[name])
    assert columns == expected_columns
    assert sum(rows.values()) > 0
    assert rows == expected


def test_every_operator_is_there():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.queries()) == list(range(1, 14))
