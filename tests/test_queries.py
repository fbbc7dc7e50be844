"""Every named query against its SQL counterpart."""

import os

import pytest

import __spark_entry__ as contract
from tests.oracle import connect, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
# The queries of the optional subpackage have their own tests.
QUERIES = {name: q for name, q in contract.queries().items() if q.__module__.startswith("siftline.plans")}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"stored_size"}
    assert set(ORACLES) <= set(QUERIES)


def test_stored_size_is_the_file_size(spark):
    assert QUERIES["stored_size"](spark, SF_DIR).first().bytes == os.path.getsize(f"{SF_DIR}/events.parquet")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns, expected = sql_rows(duck, ORACLES[name])
    assert sorted(df.columns) == columns
    actual = spark_rows(df)
    assert sum(actual.values()) > 0
    assert list((actual - expected).items())[:3] == []
    assert list((expected - actual).items())[:3] == []


def test_entry_runs(spark):
    assert contract.entry(spark).count() == 2
