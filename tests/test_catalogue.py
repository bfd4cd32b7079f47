"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from tools.check_oracle import TABLES, TYPE_NAMES, ordered, plain

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(key, spark, sf, duck):
    df = QUERIES[key](spark, sf)
    names = sorted(df.columns)
    got = [tuple(plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    cursor = duck.execute(ORACLES[key])
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(columns) == names
    assert {n: TYPE_NAMES[t] for n, t in df.dtypes} == types
    want = [tuple(plain(r[columns.index(n)]) for n in names) for r in cursor.fetchall()]
    assert ordered(got) == ordered(want)


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_rows_only_query_runs(key, spark, sf):
    assert QUERIES[key](spark, sf).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() == 6
