"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from tests.compare import differences, sql_tables


@pytest.fixture(scope="module")
def con(sf):
    return sql_tables(sf)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sf, con, name):
    if name in entry.oracle_sql():
        assert differences(spark, con, sf, name) is None
    else:
        assert entry.queries()[name](spark, sf).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 4
