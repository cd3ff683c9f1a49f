"""Every registered query against its DuckDB statement, at sf0.001."""

import datetime as dt
import math

import duckdb
import pytest

from chartwise.oracle import oracle_sql
from chartwise.registry import queries

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "<NULL>"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("key", sorted(queries()))
def test_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF)
    cols = df.columns
    rows = df.collect()
    rel = con.sql(oracle_sql()[key])
    assert sorted(cols) == sorted(rel.columns)
    order = sorted(cols)
    a = sorted(tuple(_norm(r[cols.index(c)]) for c in order) for r in rows)
    b = sorted(tuple(_norm(r[rel.columns.index(c)]) for c in order) for r in rel.fetchall())
    assert a == b


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["title", "artist", "num_countries", "total_appearances"]
    assert len(df.collect()) == 30
