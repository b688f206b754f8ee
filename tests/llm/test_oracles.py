"""Queries that SQL can express equal their SQL; none reads less than its table."""

import duckdb
import pytest

from crashgrid.llm.oracle import ORACLE_SQL
from crashgrid.llm.queries import QUERIES

from .conftest import SF


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, same_rows, name):
    df = QUERIES[name](spark, SF)
    rel = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(cols)
    assert same_rows(df.columns, df.collect()) == same_rows(cols, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op12_chat_format"}))
def test_one_row_per_input_row(spark, name):
    table = "pages" if name == "op7_warc" else "documents"
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
