"""Every registered query against its DuckDB oracle SQL at sf 0.01 (row count, columns, values)."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from ridestat.plans.oracle import oracle_sql
from ridestat.plans.registry import queries

from .conftest import SF_CHECK, SF_SMALL

TABLES = ["events", "nation"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return repr(v)


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_CHECK, t + '.parquet')}')")
    return c


def test_every_query_has_oracle_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_CHECK)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _canon(sdf.columns, srows) == _canon(ocols, orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["year", "month", "total_trips", "avg_duration_minutes", "median_duration_minutes"]
    assert len(rows) > 0
    assert entry.SMOKE_DIR == SF_SMALL
