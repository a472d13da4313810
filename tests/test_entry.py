"""The driver contract: every query runs, and agrees with its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels conversations lineitem".split()
NAMES = sorted(q for q in entry.queries() if not q.startswith("op") and q != "pipeline")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sql, name):
    got = entry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted(repr([r[c] for c in columns]) for r in got.collect())
    wanted = entry.oracle_sql().get(name)
    if wanted is None:
        assert rows
        return
    answer = sql.sql(wanted)
    assert sorted(answer.columns) == columns
    at = [answer.columns.index(c) for c in columns]
    assert rows == sorted(repr([r[i] for i in at]) for r in answer.fetchall())
