"""Every query with an oracle gives the same rows in DuckDB."""

import os

import duckdb
import pytest

from colloquy.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


def plain(value):
    return repr(round(value, 9)) if isinstance(value, float) else None if value is None else str(value)


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf, db, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=str)
    result = db.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert got == sorted(([plain(r[names.index(c)]) for c in columns] for r in result.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf, name):
    QUERIES[name](spark, sf).collect()
