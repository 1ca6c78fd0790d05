"""Every registered query against its DuckDB twin on the sf0.001 tables (order-insensitive)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from berthline.plans import catalog

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    return sorted(tuple(_norm(x) for x in r) for r in rows)


def test_every_query_has_a_builder_and_known_oracles():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.QUERIES) <= set(E.queries())
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))  # the corpus operators have tests of their own
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _rows(cols, [tuple(r[c] for c in cols) for r in df.collect()])
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = _rows(cols, [tuple(r[i] for i in idx) for r in rel.fetchall()])
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "lifetime_avg_pickup" in df.columns


@pytest.mark.parametrize("name", ["stage_durations", "parse_datetime", "json_sink", "time_parts"])
def test_query_independent_of_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = E.queries()[name](spark, SF_SMALL)
        cols = sorted(df.columns)
        got = _rows(cols, [tuple(r[c] for c in cols) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    rel = con.sql(E.oracle_sql()[name])
    idx = [rel.columns.index(c) for c in cols]
    assert got == _rows(cols, [tuple(r[i] for i in idx) for r in rel.fetchall()])
