"""Every query of the catalogue against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from statuta.plans import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the test tables")
@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DIR)
    got = sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    if name not in catalog.ORACLES:
        assert got
        return
    ref = duck.execute(catalog.ORACLES[name])
    columns = [c[0] for c in ref.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    assert sorted(columns) == sorted(df.columns)
    assert got == sorted(map(repr, (tuple(r[i] for i in order) for r in ref.fetchall())))


def test_entry_names_every_query():
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0
