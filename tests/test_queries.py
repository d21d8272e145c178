"""Every registered query against its SQL equivalent, over whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from citysignal.catalog.oracles import ORACLES
from citysignal.catalog.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_equivalent():
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.queries().keys() >= QUERIES.keys()
    assert contract.queries().keys() >= contract.oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(row)) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    result = oracle.execute(contract.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    want = sorted(repr(tuple(row[i] for i in order)) for row in result.fetchall())
    assert got == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0
