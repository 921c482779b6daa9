"""Every query with SQL against DuckDB on the smallest tables."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
ORACLE = entry.oracle_sql()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return str(v.normalize()) if isinstance(v, decimal.Decimal) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", ORACLE)
def test_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    told = duck.sql(ORACLE[name])
    assert sorted(told.columns) == columns
    at = [told.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in told.fetchall()), key=repr)


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(ORACLE) <= set(entry.queries())
    for n in (2, 3, 4, 5):
        assert f"p{n}_found" in entry.queries()


def test_serving_has_no_nested_loop(spark):
    for name in ("q16_serve_union", "q05_exclude_anti", "q17_serve_fields"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
