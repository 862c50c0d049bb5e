"""Every market query at the smallest size; those with SQL against DuckDB."""

import math
from decimal import Decimal

import duckdb
import pytest

from tickloom.plans import market

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, Decimal):
        return float(v)
    return "nan" if isinstance(v, float) and math.isnan(v) else v


def key(row):
    return tuple((v is None, str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(market.queries()))
def test_query(spark, duck, name):
    df = market.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key)
    sql = market.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    found = duck.execute(sql)
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[k]) for k in at) for r in found.fetchall()), key=key)
