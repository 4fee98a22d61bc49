"""Every registered query against its SQL counterpart in DuckDB."""

import pytest

from __spark_entry__ import entry
from snaphist.catalog import all_queries as queries
from snaphist.oracle import oracle_sql
from tests.compare import compare, connect
from tests.conftest import SF_DIR

SQL = oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(queries()) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, connection, name):
    assert compare(queries()[name](spark, SF_DIR), connection, SQL[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0
