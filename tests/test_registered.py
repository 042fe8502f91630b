"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from indexloom.workload.registered import QUERIES
from indexloom.workload.roles import TABLES

#: Queries of the subpackage llm have their own tests.
NAMES = [n for n in entry.queries() if n in QUERIES]


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def canon(rows):
    fix = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(fix(v) for v in r) for r in rows), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    got = canon(tuple(r) for r in df.select(*columns).collect())
    text = entry.oracle_sql()[name]
    want = canon(con.execute(f"select {', '.join(columns)} from ({text}) t").fetchall())
    assert got == want


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
