"""Every query with reference SQL, side by side with DuckDB on the smallest data set."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.date):
        return value.isoformat()[:10]
    return value


def test_every_reference_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_reference(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    duck.execute(f"CREATE OR REPLACE VIEW reference AS {SQL[name]}")  # as the driver reads it
    result = duck.execute("SELECT * FROM reference")
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    ours = [tuple(plain(row[c]) for c in columns) for row in df.collect()]
    theirs = [tuple(plain(v) for v in row) for row in result.fetchall()]
    assert sorted(ours, key=repr) == sorted(theirs, key=repr)


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert {"customer_id", "segment", "rfm_score"} <= set(df.columns)
    assert df.count() > 0
