"""Every registered query against its DuckDB oracle on sf0.001 (the driver's check runs sf0.01)."""

import math

import duckdb
import pytest

from trellis.plans.fixtures import TABLES
from trellis.plans.registry import load_all

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = load_all()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert df.columns
        return
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _digest(df.columns, got) == _digest(ocols, exp)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    out = e.entry(spark)
    assert out.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
