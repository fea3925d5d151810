"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from veriframe.plans.registered import QUERIES, SQL
from compare import difference, oracle_connection, oracle_rows, spark_rows


@pytest.fixture(scope="module")
def oracle(sf):
    return oracle_connection(sf)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf, oracle, key):
    actual = spark_rows(QUERIES[key](spark, sf))
    assert difference(actual, oracle_rows(oracle, SQL[key])) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() == 5
