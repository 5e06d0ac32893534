"""Every registered query against its SQL, row for row."""

import math
import os
import pathlib
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from workload import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in pathlib.Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return float(value) if isinstance(value, Decimal) else value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, name):
    result = QUERIES[name](spark, SF_DIR)
    relation = sql.execute(ORACLES[name])
    columns = [d[0] for d in relation.description]
    assert sorted(result.columns) == sorted(columns)
    got = canonical(result.columns, result.collect())
    want = canonical(columns, relation.fetchall())
    assert got == want
    assert got


def test_entry(spark):
    assert contract.entry(spark).count() > 0
