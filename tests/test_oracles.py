"""Every query with an SQL counterpart gives the same rows, names and types in both engines."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.01"
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(rows):
    def one(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        return repr(v) if isinstance(v, float) else str(v)

    return sorted(tuple(one(v) for v in r) for r in rows)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    ours = QUERIES[name](spark, SF_DIR)
    names = sorted(ours.columns)
    theirs = con.sql(SQL[name])
    assert names == sorted(theirs.columns)
    types = dict(zip(theirs.columns, map(str, theirs.types)))
    assert {c: TYPES[t] for c, t in ours.dtypes} == types
    got = comparable(tuple(r[c] for c in names) for r in ours.collect())
    spots = [theirs.columns.index(c) for c in names]
    assert got == comparable(tuple(r[i] for i in spots) for r in theirs.fetchall())


def test_entry_runs(spark):
    flagship = entry.entry(spark)
    assert flagship.count() == 823
    assert flagship.columns[:2] == ["pickup_hour_ts", "PULocationID"]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_other_queries_run(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
