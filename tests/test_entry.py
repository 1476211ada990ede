"""The contract: every query runs on the smallest data, and agrees with its SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

CORE = [m.R for m in map(__import__("importlib").import_module, entry.MODULES)]
NAMES = sorted(n for r in CORE for n in r.queries)


@pytest.fixture(scope="session")
def views(small):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in os.listdir(small):
        con.execute(f"create view {f[:-8]} as select * from '{small}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if type(v).__name__ == "Decimal":
        return float(f"{float(v):.9g}")
    return v


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_sql_names_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, small, views, name):
    df = entry.queries()[name](spark, small)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if not sql:
        assert df.columns
        return
    got = views.execute(sql)
    cols = [c[0] for c in got.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted((tuple(plain(r[cols.index(c)]) for c in sorted(cols)) for r in got.fetchall()), key=repr)
    have = sorted((tuple(plain(r[c]) for c in sorted(cols)) for r in rows), key=repr)
    assert have == want
