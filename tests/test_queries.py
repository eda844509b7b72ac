"""Every registered query against its SQL counterpart, on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_file
from corpusforge.catalog.oracles import ORACLES
from corpusforge.catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_file.queries()) and set(ORACLES) <= set(entry_file.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    problem = differences(QUERIES[name](spark, FOLDER), connection, ORACLES[name])
    assert problem is None, problem


def test_entry(spark):
    rows = entry_file.entry(spark)
    assert rows.columns == ["messages", "source_id", "category"] and rows.count() > 0
