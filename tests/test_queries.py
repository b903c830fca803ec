"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import compare

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], ORACLES.get(name), FOLDER)
    assert result.startswith(("ok", "rows only", "EMPTY")) and "TYPES" not in result, result


def test_names():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
