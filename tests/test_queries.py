"""Every registered query against its SQL statement on the small data set."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = os.environ.get("SHIFTLENS_TEST_DATA", "/root/testdata/sf0.001")
ORACLE = entry.STATEMENTS
QUERIES = {k: f for k, f in entry.queries().items() if k in entry.QUERIES}


def clean(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 6) if isinstance(v, float) else v


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"create view events as select * from '{DATA}/events.parquet'")
    return c


def test_names_agree():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = [tuple(clean(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = [tuple(clean(r[i]) for i in at) for r in cur.fetchall()]
    assert ordered(got) == ordered(want)


def test_entry_is_the_shift_oee(spark):
    df = entry.entry(spark)
    assert {"shift_key", "oee", "availability", "performance", "quality"} <= set(df.columns) and df.count() > 100
