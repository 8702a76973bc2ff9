"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, duck

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


def test_entry(spark):
    assert entry(spark).columns[:3] == ["metier", "pays", "ville"]


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
