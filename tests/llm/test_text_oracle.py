"""Queries that SQL can express, against their SQL twins on the whole given tables."""

import duckdb
import pytest

from tradelake.llm.oracle_sql import ORACLE
from tradelake.llm.queries import QUERIES

TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    theirs = sorted(tuple(map(str, row)) for row in result.fetchall())
    ours = sorted(tuple(str(row[c]) for c in names) for row in df.collect())
    assert ours == theirs
