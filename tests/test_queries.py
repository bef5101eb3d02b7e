"""Every query against its SQL counterpart, values, names and types alike."""

import pytest

import harness
from __spark_entry__ import entry, oracle_sql, queries
from samples import TESTDATA

SF = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return harness.duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    result = queries()[name](spark, SF).toArrow()
    assert harness.compare(result, duck.sql(oracle_sql()[name]).to_arrow_table()) == []


def test_entry(spark):
    assert entry(spark).count() == 83


def test_statements_have_queries():
    assert set(oracle_sql()) <= set(queries())
