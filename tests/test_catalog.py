"""Every registered query against its SQL in another engine."""

import os

import duckdb
import pytest
from catalog import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, engine, name):
    got = QUERIES[name](spark, SF_DIR)
    columns = sorted(got.columns)
    described = engine.execute(f"DESCRIBE {SQL[name]}").fetchall()
    expected_types = {row[0]: row[1] for row in described}
    assert columns == sorted(expected_types)
    assert {c: TYPES[t] for c, t in got.dtypes} == expected_types

    chosen = ", ".join(columns)
    expected = engine.execute(f"SELECT {chosen} FROM ({SQL[name]})").fetchall()
    actual = [tuple(r) for r in got.select(*columns).collect()]
    assert len(actual) == len(expected)
    assert sorted(actual, key=repr) == sorted(expected, key=repr)
    assert actual
