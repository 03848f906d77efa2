"""Every core query with SQL against DuckDB on the smallest tables."""

import math
from pathlib import Path

import pytest

from tarnquill.plans import bundle_queries, corpus_queries, datasets, keyword_queries, release_queries, text_queries, title_queries, topic_queries, vector_queries

FOLDER = Path("/root/testdata/sf0.001")
MODULES = (bundle_queries, corpus_queries, datasets, keyword_queries, release_queries, text_queries, title_queries, topic_queries, vector_queries)
SQL = {k: v for m in MODULES for k, v in getattr(m, "SQL", {}).items()}
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _rows(frame):
    def text(v):
        if v is None or isinstance(v, float) and math.isnan(v) or str(v) in ("<NA>", "NaT"):
            return ""
        return f"{v:.6g}" if isinstance(v, float) else str(v)

    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(text, r)) for r in frame[columns].itertuples(index=False, name=None))


def test_names():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert _rows(QUERIES[name](spark, str(FOLDER)).toPandas()) == _rows(duck.sql(SQL[name]).fetchdf())
