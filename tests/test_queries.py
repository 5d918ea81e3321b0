"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

import oracle_check
from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def sql():
    return oracle_check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    got = queries()[name](spark, FOLDER).toPandas()
    assert oracle_check.difference(got, sql.execute(oracle_sql()[name]).df()) is None


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
