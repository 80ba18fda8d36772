"""Every query with SQL equals DuckDB on the small tables: rows, names and values."""

import math
import os

import duckdb
import pytest

from adlake.plans import oracle, registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda k: cols[k])
    return sorted(tuple(plain(r[k]) for k in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("key", sorted(oracle.ORACLES))
def test_equals_duckdb(spark, duck, key):
    got = registry.QUERIES[key](spark, DATA)
    want = duck.sql(oracle.ORACLES[key])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("key", sorted(set(registry.QUERIES) - set(oracle.ORACLES)))
def test_has_rows(spark, key):
    assert registry.QUERIES[key](spark, DATA).count() > 0
