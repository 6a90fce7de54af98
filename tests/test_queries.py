"""Every registered query against independent SQL on the same tables."""

import pytest
from conftest import rows_of, rows_of_sql

import __spark_entry__ as contract
from tillmart.fixture.queries import registry

ORACLE = contract.oracle_sql()


@pytest.mark.parametrize("name", list(registry()))
def test_query_equals_sql(spark, duck, folder, name):
    names, rows = rows_of(contract.queries()[name](spark, folder))
    expected_names, expected = rows_of_sql(duck, ORACLE[name])
    assert names == expected_names
    assert len(rows) == len(expected)
    assert rows == expected


def test_every_query_has_sql():
    assert set(registry()) <= set(ORACLE)
    assert set(registry()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
