"""Every query with an SQL twin gives the same rows as DuckDB on the same files."""

import pytest

from cohorta import catalog
from tools.check_oracles import compare, connect

ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    problem, rows = compare(spark, duck, name, catalog.queries()[name], ORACLES[name], sf_dir)
    assert problem is None
    assert rows > 0 or name in ("smote_rows",)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(catalog.queries())


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
