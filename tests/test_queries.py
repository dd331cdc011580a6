"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from fixtures import registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN",
    "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def in_order(rows, names, columns):
    return sorted(tuple(repr(r[names.index(c)]) for c in columns) for r in rows)


def test_each_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    relation = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    sql_types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES.get(t, t.upper()) for c, t in df.dtypes} == sql_types
    expected = relation.fetchall()
    assert in_order(df.collect(), df.columns, columns) == in_order(expected, list(relation.columns), columns)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(ORACLES) - {"fit_score"}))
def test_other_queries_run(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() >= 1


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1000
