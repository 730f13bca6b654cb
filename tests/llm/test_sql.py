"""Corpus queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from centigram.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = connection.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    got = QUERIES[name](spark, FOLDER).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(result.fetchall())
