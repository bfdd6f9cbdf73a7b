"""Every registered query against its SQL on the driver tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tools.compare import normal

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        con.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = duck.sql(SQL[name]).df()
    assert len(got)
    pd.testing.assert_frame_equal(normal(got), normal(want), check_exact=True)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["unit_id", "line", "energy_consumption"]
    assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
