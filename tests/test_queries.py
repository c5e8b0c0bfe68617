"""Every registered query against SQL over the same tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tristrata.plans.catalogue import QUERIES
from tristrata.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, oracle, name):
    df = contract.queries()[name](spark, SF_DIR)
    expected = oracle.execute(contract.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    columns = sorted(df.columns)
    assert columns == sorted(names)
    order = [names.index(c) for c in columns]
    rows = [[r[i] for i in order] for r in expected.fetchall()]
    got = [list(r) for r in df.select(*columns).collect()]
    assert got
    assert sorted(map(repr, got)) == sorted(map(repr, rows))


def test_entry(spark):
    assert contract.entry(spark).count() == 6
