"""Every query with SQL against DuckDB, over the smallest tables."""

import datetime as dt
import math
from pathlib import Path

import pytest

import __spark_entry__ as entry

FOLDER = Path("/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def con():
    if not FOLDER.exists():
        pytest.skip("no test tables here")
    c = duckdb.connect()
    for f in FOLDER.glob("*.parquet"):
        c.execute(f"create view {f.stem} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_says_what_its_sql_says(spark, con, name):
    df = entry.queries()[name](spark, str(FOLDER))
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(tuple(norm(r[cols.index(c)]) for c in sorted(cols)) for r in cur.fetchall())
    got = sorted(tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect())
    assert got == want


def test_entry_runs(spark):
    if FOLDER.exists():
        assert entry.entry(spark).count() > 0
