"""Every registered change-stream query against its DuckDB oracle, at the smallest scale."""

import decimal
import os
from pathlib import Path

import duckdb
import pytest

from tidemark.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    return con


def value(x):
    if x is None or x != x:
        return None
    if isinstance(x, (float, decimal.Decimal)) and x == int(x):
        return int(x)
    return x


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    out = duck.execute(ORACLES[name])
    names = [d[0] for d in out.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted(str(tuple(value(r[names.index(c)]) for c in df.columns)) for r in out.fetchall())
    got = sorted(str(tuple(map(value, r))) for r in df.collect())
    assert got == want


def test_all_have_oracles():
    assert set(QUERIES) == set(ORACLES)


def test_pushdown(spark, sf):
    """The bulk query reads four columns of lineitem."""
    plan = QUERIES["order_change_mods"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in plan


def test_filter_stands_below_explode(spark, sf):
    plan = QUERIES["table_include"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan or plan.index("Generate") < plan.rindex("RLIKE")
