"""The queries of the corpus operators against SQL, and the pipeline against its parts."""

import os

import duckdb
import pytest

import corpus_pipeline
from lazaret.llm import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF_DIR)
    cursor = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    expected = sorted(tuple(repr(row[names.index(c)]) for c in columns) for row in cursor.fetchall())
    assert sorted(tuple(repr(r[c]) for c in columns) for r in df.collect()) == expected


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == columns, name
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert after < before or name == "decontaminated" and after <= before
        before = after
    packed = corpus_pipeline.run(spark, SF_DIR).groupBy("doc_id", "doc_tokens").sum("length").collect()
    assert {r["doc_id"] for r in packed} == before and all(r["doc_tokens"] == r["sum(length)"] for r in packed)
