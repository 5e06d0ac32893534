"""Registered queries of the subpackage against their SQL, row for row."""

import pathlib

import duckdb
import pytest

from lakeseries.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in pathlib.Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sql, name):
    relation = sql.execute(ORACLES[name])
    columns = sorted(d[0] for d in relation.description)
    order = [[d[0] for d in relation.description].index(c) for c in columns]
    want = sorted((tuple(row[i] for i in order) for row in relation.fetchall()), key=repr)
    result = QUERIES[name](spark, SF_DIR)
    assert sorted(result.columns) == columns
    got = sorted((tuple(row) for row in result.select(*columns).collect()), key=repr)
    assert got == want and got
