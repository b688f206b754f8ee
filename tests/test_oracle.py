"""Driver contract: every registered query equals its DuckDB SQL twin at sf0.01
(row count, column names, types and an order-insensitive hash of the values)."""

import hashlib
import math

import pytest

import __spark_entry__ as E
from crashgrid.plans.catalogue import QUERIES as CATALOGUE

from .conftest import SF_ORACLE, SF_SMALL, have_data

duckdb = pytest.importorskip("duckdb")

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "date": "DATE"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    if not have_data(SF_ORACLE):
        pytest.skip("driver tables absent")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(CATALOGUE) - set(E.oracle_sql()) == {"row_and_partition_counts"}  # SQL knows no partitions
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    if not have_data(SF_SMALL):
        pytest.skip("driver tables absent")
    df = E.entry(spark)
    assert df.columns == ["Area_Name", "Peak_Hour", "Peak_Collisions"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(set(CATALOGUE) & set(E.oracle_sql())))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_ORACLE)
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    dtypes = [str(d[1]) for d in rel.description]
    drows = rel.fetchall()
    assert df.columns == dcols
    assert [TYPE_MAP[f.dataType.simpleString()] for f in df.schema.fields] == dtypes
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)


@pytest.mark.parametrize("name", ["count_by_hour_band", "count_by_day", "weekend_daily_average", "monthly_trend"])
def test_time_zone_independent(spark, con, name):
    """Timestamps are read as timestamp_ntz: a caller's session time zone does
    not move hours or days."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF_ORACLE)
        srows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert _digest(df.columns, srows) == _digest(dcols, rel.fetchall())
