"""Every registered query against its SQL twin; those without one must at least return rows."""

import pytest
from compare import connect, mismatch

import __spark_entry__ as contract

QUERIES = contract.queries
ORACLE = contract.oracle_sql()


def test_every_sql_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES())


@pytest.fixture(scope="module")
def con(src):
    return connect(src)


@pytest.mark.parametrize("name", sorted(QUERIES()))
def test_query(name, spark, src, con):
    df = QUERIES()[name](spark, src)
    if name in ORACLE:
        difference = mismatch(df, ORACLE[name], con)
        assert difference is None, difference
    else:
        assert df.count() > 0


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
