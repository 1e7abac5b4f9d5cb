"""Every registered query against its DuckDB oracle (the driver's correctness gate), at sf0.001."""

import math

import duckdb
import pytest

from conftest import SF001

from __spark_entry__ import oracle_sql, queries
from textgate.plans.fixtures import TABLES
from textgate.plans.queries import QUERIES

ORACLE = oracle_sql()
NAMES = sorted(QUERIES)  # the optional operators' queries have tests of their own


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(ORACLE)
    assert set(NAMES) <= set(queries()) and set(ORACLE) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert canon(df.columns, rows) == canon(res.columns, res.fetchall())
