"""Every query of this subpackage runs on the smallest data, and agrees with its SQL where it has one."""

import os

import duckdb
import pytest

from harvestry.llm.queries import R


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(R.queries))
def test_query(spark, small, name):
    df = R.queries[name](spark, small)
    rows = df.collect()
    if name not in R.sql:
        assert rows and df.columns
        return
    con = duckdb.connect()
    for f in os.listdir(small):
        con.execute(f"create view {f[:-8]} as select * from '{small}/{f}'")
    got = con.execute(R.sql[name])
    cols = [c[0] for c in got.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted((tuple(plain(r[cols.index(c)]) for c in sorted(cols)) for r in got.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in sorted(cols)) for r in rows), key=repr) == want
