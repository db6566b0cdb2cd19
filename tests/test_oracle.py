"""Every query with SQL gives DuckDB's rows on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from corpuskit.plans import queries as core

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


def rounded(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_query(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = core.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    want = con.execute(core.oracle_sql()[name])
    at = [d[0] for d in want.description]
    assert sorted(at) == columns
    key = lambda t: tuple((x is None, str(x)) for x in t)
    rows = sorted((tuple(rounded(r[at.index(c)]) for c in columns) for r in want.fetchall()), key=key)
    assert sorted((tuple(rounded(r[c]) for c in columns) for r in df.collect()), key=key) == rows


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
