"""Queries with fixed columns on tables where one row lifts the variance of a ratio over the floor."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from tools.check_oracle import TYPE_NAMES, ordered, plain


@pytest.fixture(scope="module")
def tiny_income(sf, tmp_path_factory):
    """The smallest tables, where customer 1 has one cheap order with one cheap line."""
    folder, con = tmp_path_factory.mktemp("tiny"), duckdb.connect()
    for name in ("customer", "orders", "lineitem"):
        con.execute(f"create table {name} as select * from '{sf}/{name}.parquet'")
    con.execute("update customer set c_acctbal = 9999.0 where c_custkey = 1")
    con.execute("create table one as select min(o_orderkey) as k from orders where o_custkey = 1")
    con.execute("update orders set o_custkey = 2 where o_custkey = 1 and o_orderkey <> (select k from one)")
    con.execute("update orders set o_totalprice = 12.0 where o_custkey = 1")
    con.execute("update lineitem set l_extendedprice = 0.5 where l_orderkey = (select k from one)")
    for name in ("customer", "orders", "lineitem"):
        con.execute(f"copy {name} to '{folder}/{name}.parquet'")
    return con, str(folder)


@pytest.mark.parametrize("key", ["assemble_matrix", "feature_transform_fitted"])
def test_columns_do_not_hang_on_one_row(key, spark, tiny_income):
    con, folder = tiny_income
    df = entry_points.queries()[key](spark, folder)
    names = sorted(df.columns)
    cursor = con.execute(entry_points.oracle_sql()[key])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == names
    assert {n: TYPE_NAMES[t] for n, t in df.dtypes} == {d[0]: str(d[1]) for d in cursor.description}
    want = [tuple(plain(r[columns.index(n)]) for n in names) for r in cursor.fetchall()]
    assert ordered([tuple(plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect()]) == ordered(want)
