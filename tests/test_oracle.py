"""Every registered query against its SQL twin, value by value and type by type."""

import duckdb
import pytest

from orderlens.plans.catalog import queries
from orderlens.plans.oracle import oracle_sql

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}
QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    found = sorted(repr(tuple(row[c] for c in columns)) for row in df.collect())

    relation = duck.sql(SQL[name])
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = [relation.columns.index(c) for c in columns]
    expected = sorted(repr(tuple(row[i] for i in order)) for row in relation.fetchall())
    assert found == expected
