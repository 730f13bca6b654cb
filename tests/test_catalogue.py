"""Every query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return repr(value)


def table(columns, rows):
    order = sorted(columns)
    places = [columns.index(c) for c in order]
    return order, sorted(tuple(cell(row[i]) for i in places) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    rows = df.collect()
    result = tables.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert table(df.columns, [tuple(r) for r in rows]) == table(columns, result.fetchall())


def test_entry(spark):
    report = entry(spark)
    assert report.count() == 15
