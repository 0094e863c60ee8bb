"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from compare import duck, spark_rows, sql_rows

from hilvan import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    if name not in SQL:
        assert rows
        return
    sql_columns, expected = sql_rows(con, SQL[name])
    assert columns == sql_columns
    assert rows == expected
