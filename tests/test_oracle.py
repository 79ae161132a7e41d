"""Each registered query against its SQL in DuckDB, over the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lazaret.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    expected = sorted(
        tuple(repr(row[names.index(c)]) for c in columns) for row in cursor.fetchall()
    )
    found = sorted(tuple(repr(r[c]) for c in columns) for r in df.collect())
    assert found == expected and found


def test_entry(spark):
    assert entry.entry(spark).count() == 6000
