"""Registered queries against their oracle, and the pipeline."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from check import rows

import corpus_pipeline
from quayside.llm.catalogue import ORACLES, QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="the provided tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got, want = QUERIES[name](spark, str(SF_DIR)).toPandas(), connection.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_all_documents(spark, name):
    got = QUERIES[name](spark, str(SF_DIR)).toPandas()
    want = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").toPandas()
    assert set(got.doc_id) == set(want.doc_id)


def test_pipeline(spark, odd):
    pieces = corpus_pipeline.run(spark, str(SF_DIR)).toPandas()
    assert len(pieces) and pieces.length.max() <= 2048
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == odd.columns, name
