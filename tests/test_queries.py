"""Every registered query next to its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SF}/{file}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    result = db.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    mine = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(map(repr, mine)) == sorted(map(repr, theirs))


def test_entry(spark):
    assert entry(spark).count() > 0
