"""Every registered query equals its independent DuckDB SQL twin on the sf0.001 tables."""

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

from admart.oracle import ORACLE_SQL
from admart.queries import QUERIES


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        f = float(v)
        return "nan" if math.isnan(f) else (repr(f) if digits is None else f"{f:.{digits}g}")
    if isinstance(v, (date, datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return str([_norm(x, digits) for x in v])
    return str(v)


def _bag(rows, cols, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i], digits) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in ("events", "lineitem", "orders", "part", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, duck, name):
    sdf = QUERIES[name](spark, sf_small)
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(ORACLE_SQL[name])
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert _bag(srows, sdf.columns, None) == _bag(drows, rel.columns, None)
