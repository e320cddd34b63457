"""Every registered query against the SQL that states its result, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from cartulary.plans import base

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    return repr(float(v)) if isinstance(v, float) else f"{type(v).__name__}:{v}"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(value(r[c]) for c in cols) for r in df.collect())
    result = duck.execute(ORACLES[name])
    at = [d[0] for d in result.description]
    assert sorted(at) == cols
    want = sorted(tuple(value(r[at.index(c)]) for c in cols) for r in result.fetchall())
    assert got == want


def test_every_query_has_its_sql():
    assert set(base.QUERIES) == set(base.ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
