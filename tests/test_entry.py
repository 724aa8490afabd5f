"""The registered queries run and agree with their SQL on the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as entry
from quireflow.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def value(x):
    return round(x, 6) if isinstance(x, float) else x


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(([value(r[c]) for c in columns] for r in df.collect()), key=repr)
    if name in registry.ORACLES:
        cur = duck.execute(registry.ORACLES[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == columns
        assert got == sorted(([value(r[names.index(c)]) for c in columns] for r in cur.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
