"""Differential check: every registered query with an oracle against DuckDB (sf0.001),
plus the rows-only queries and the entry point."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tools.check_oracles import TABLES, digest

from .conftest import SF_SMALL

ORACLES = entry_mod.oracle_sql()
QUERIES = entry_mod.queries()
FAST_ROWS_ONLY = ["naive_bayes_metrics", "logreg_attempts"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


@pytest.mark.parametrize("name", FAST_ROWS_ONLY)
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 1


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["id", "ostatus", "priority", "status", "grp"]
    assert df.count() > 0


def test_every_query_reads_tables():
    assert set(ORACLES) <= set(QUERIES)
