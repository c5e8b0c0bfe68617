"""Registered queries against SQL, and that every operator has one query."""

import duckdb
import pytest

from tristrata.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = connection.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(columns)
    rows = sorted(map(repr, expected.fetchall()))
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == rows
