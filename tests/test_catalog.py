"""Every registered query against its SQL on DuckDB, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__
from revlens.plans.catalog import catalog
from tests.oracle import compare, connect

QUERIES = catalog()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_same_as_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, QUERIES[name]) == []


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_runs(spark, sf_dir, name):
    df = QUERIES[name].run(spark, sf_dir)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_entry_points(spark):
    flagship = __spark_entry__.entry(spark)
    assert flagship.columns == ["source", "n_rows", "positive", "positive_rate"]
    assert flagship.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
