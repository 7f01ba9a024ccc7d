"""Registered queries against their SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from quarry.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(repr([r[c] for c in columns]) for r in df.collect())
    if name in registry.ORACLES:
        found = duck.execute(registry.ORACLES[name])
        names = [d[0] for d in found.description]
        assert sorted(names) == columns
        assert rows == sorted(repr([r[names.index(c)] for c in columns]) for r in found.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
