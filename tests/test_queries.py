"""Every query with an SQL twin agrees with DuckDB on the smallest test data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracles import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    problem = compare(entry.queries()[name](spark, SF).toPandas(), db.sql(entry.oracle_sql()[name]).df())
    assert not problem, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
