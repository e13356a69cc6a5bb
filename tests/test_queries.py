"""Every registered query against its oracle, and the driver contract."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from check import rows
from quayside.plans.catalogue import ORACLES, QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="the provided tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    got = QUERIES[name](spark, str(SF_DIR)).toPandas()
    want = oracle.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    first = entry_point.entry(spark)
    assert first.count() > 0
    assert first.schema == entry_point.entry(spark).schema
