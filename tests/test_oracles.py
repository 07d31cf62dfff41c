"""Every query that has SQL agrees with it on the smallest tables; the others run."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from newsloom.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        repr([round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order]) for r in data
    )


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    found = [tuple(r) for r in df.collect()]
    cursor = db.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, found) == canonical(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_the_entry_has_all_queries():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
