"""Driver contract: flagship entry, and every registered query against its
DuckDB oracle on sf0.001 (row count, column names, order-insensitive values)."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

from .conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["grp", "date", "stock_symbol", "buyer", "cuml", "cumq", "trnxs", "pc_change"]
    assert len(rows) > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows) == digest(dcols, drows)
