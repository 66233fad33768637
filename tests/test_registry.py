"""Every registered query runs, declares its double columns, and matches its
DuckDB oracle on the smallest scale factor."""

import math

import duckdb
import pytest
from pyspark.sql import types as T

import __spark_entry__ as E
from scorewright.plans import REGISTRY
from scorewright.sources.tables import DRIVER_TABLES

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if hasattr(v, "tolist"):
        return tuple(v.tolist())
    return v


SQL_NAMES = sorted(n for n, q in REGISTRY.items() if q.sql is not None)


@pytest.mark.parametrize("name", SQL_NAMES)
def test_query_matches_oracle(spark, duck, name):
    q = REGISTRY[name]
    sdf = E.queries()[name](spark, SF_SMALL)
    # rounding keeps the types, so the returned frame's schema is the builder's
    doubles = {f.name for f in sdf.schema.fields if isinstance(f.dataType, T.DoubleType)}
    assert doubles == set(q.doubles), f"declared doubles differ: {doubles ^ set(q.doubles)}"
    rel = duck.sql(E.oracle_sql()[name])
    cols = sorted(sdf.columns)
    assert cols == sorted(rel.columns)
    a = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    idx = [rel.columns.index(c) for c in cols]
    b = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert a == b
