"""Every registered query of the library against its SQL in DuckDB, on the smallest tables."""

import pytest
from conftest import DATA, duck, duck_rows, rows_of

from revlake.plans import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert rows_of(QUERIES[name](spark, DATA)) == duck_rows(con, SQL[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
