"""Every registered query of the library against its SQL on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

from tablewright import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else int(v) if v == int(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, decimal.Decimal):
        return plain(float(v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(name, spark, sf_dir, duck):
    df = registry.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    rel = duck.sql(sql)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert rows == sorted(repr(tuple(plain(r[i]) for i in at)) for r in rel.fetchall())
