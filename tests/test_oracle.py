"""Each query with SQL gives the same columns and rows as DuckDB; the others run."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from sluice.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def rows(frame):
    return sorted(frame[sorted(frame.columns)].map(str).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_sql(spark, sf_dir, duck, name):
    got, want = registry.QUERIES[name](spark, sf_dir).toPandas(), duck.sql(registry.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) <= set(entry.queries())
