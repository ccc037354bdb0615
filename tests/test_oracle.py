"""Every registered query with an SQL form against DuckDB on the sf0.001 tables."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as entry
from cadenza.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables missing")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if isinstance(x, float):
            return round(x, 6)
        if isinstance(x, datetime.datetime):
            return x.replace(tzinfo=None)
        return x
    return sorted((tuple(v(r[i]) for i in order) for r in rows), key=repr)


SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


def test_every_query_registered():
    qs = entry.queries()
    assert set(SQL) <= set(qs)
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _norm(got, df.columns) == _norm(res.fetchall(), cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["recording_mbid", "recording_count", "user_count", "average_count", "position"]
    assert 0 < df.count() <= 100
