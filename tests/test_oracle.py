"""Every registered query against its SQL twin, on the whole given tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from workload.oracle import ORACLE as SQL
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    return repr(round(value, 6) + 0.0) if isinstance(value, float) else str(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = con.execute(SQL[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    columns = sorted(types)
    order = [list(types).index(c) for c in columns]
    theirs = sorted(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    ours = sorted(tuple(_plain(row[c]) for c in columns) for row in df.collect())
    assert ours == theirs


def test_entry_and_peek(spark, sf_dir):
    assert entry_points.entry(spark).count() > 0
    assert QUERIES["peek"](spark, sf_dir).count() == 10
