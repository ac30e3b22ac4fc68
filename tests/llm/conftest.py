import duckdb
import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def docs(spark):
    """Build a table of documents from (doc_id, text) or (doc_id, text, lang) rows."""

    def build(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture(scope="session")
def read(sf_dir):
    """Rows of a given table by plain SQL."""
    return lambda sql: duckdb.sql(sql.format(d=sf_dir)).fetchall()
