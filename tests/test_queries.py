"""Every query against its SQL in DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from netquill.plans import registry

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(DIR):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DIR}/{f}'")
    return con


def rows(found, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(x):
        if isinstance(x, bool) or x is None:
            return str(x)
        if isinstance(x, float) or type(x).__name__ == "Decimal":
            return repr(round(float(x), 6) + 0.0)
        if getattr(x, "tzinfo", None):
            x = x.replace(tzinfo=None)
        return str(x)

    return sorted(tuple(value(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, DIR)
    got = rows(df.collect(), df.columns)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got or name in ("cusum_trace",)
        return
    cur = duck.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(cur.fetchall(), names)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
