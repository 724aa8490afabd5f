"""The keyed store: versions, replacement, interrupted runs."""

import os

import pytest
from pyspark.sql import functions as F

from quireflow.sources import store

KIND = "k long, v string, n int"


def rows(spark, *values):
    return spark.createDataFrame(list(values), KIND)


def read(spark, to, version=None):
    return sorted((tuple(r) for r in store.read(spark, to, version).select("k", "v", "n").collect()), key=repr)


def test_upsert(spark, tmp_path):
    to = str(tmp_path / "s")
    assert not store.exists(spark, to)
    assert store.upsert(rows(spark, (1, "a", 1), (2, "b", 1), (None, "null", 1), (3, "c", 1)), to, "k", buckets=1) == 1
    assert store.upsert(rows(spark, (2, "old", 1), (2, "new", 2), (4, "d", 1), (None, "null again", 1)), to, "k", order="n") == 2
    assert read(spark, to) == sorted([(1, "a", 1), (2, "new", 2), (3, "c", 1), (4, "d", 1), (None, "null again", 1)], key=repr)
    assert read(spark, to, 1) == sorted([(1, "a", 1), (2, "b", 1), (3, "c", 1), (None, "null", 1)], key=repr)
    assert store.upsert(rows(spark), to, "k") == 3
    assert read(spark, to) == read(spark, to, 2)
    assert store.vacuum(spark, to) > 0 and store.versions(spark, to) == [3]
    assert len(read(spark, to)) == 5 and store.vacuum(spark, to) == 0
    with pytest.raises(ValueError):
        store.read(spark, to, 1)
    with pytest.raises(ValueError):
        store.upsert(rows(spark), to, "v")


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    to = str(tmp_path / "s")
    store.upsert(spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(1).alias("n")), to, "k", buckets=8)
    before = {p for p, _, _ in os.walk(to)}
    store.upsert(rows(spark, (5, "b", 1)), to, "k")
    new = [p for p, _, _ in os.walk(to) if p not in before and "bucket=" in p]
    assert len(new) == 1
    assert read(spark, to) == sorted([(i, "b" if i == 5 else "a", 1) for i in range(100)], key=repr)


def test_an_interrupted_run_leaves_the_version_before(spark, tmp_path, monkeypatch):
    to = str(tmp_path / "s")
    store.upsert(rows(spark, (1, "a", 1)), to, "k")

    def stopped(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(store, "_switch", stopped)
        with pytest.raises(KeyboardInterrupt):
            store.upsert(rows(spark, (1, "b", 1)), to, "k")
    assert read(spark, to) == [(1, "a", 1)] and store.versions(spark, to) == [1]
    store.upsert(rows(spark, (1, "c", 1)), to, "k")
    assert read(spark, to) == [(1, "c", 1)]


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    """Both start from version 1; the second to finish fails and leaves the first one's rows."""
    to = str(tmp_path / "s")
    store.upsert(rows(spark, (1, "a", 1)), to, "k")
    with monkeypatch.context() as m:
        m.setattr(store, "versions", lambda *a: [1])
        store.upsert(rows(spark, (1, "first", 1)), to, "k")
        with pytest.raises(RuntimeError):
            store.upsert(rows(spark, (1, "second", 1)), to, "k")
    assert read(spark, to) == [(1, "first", 1)]


def test_columns_may_come_and_go(spark, tmp_path):
    to = str(tmp_path / "s")
    store.upsert(rows(spark, (1, "a", 1)), to, "k")
    store.upsert(spark.createDataFrame([(2, True, "x")], "k long, more boolean, generation string"), to, "k")
    got = {r["k"]: (r["v"], r["more"]) for r in store.read(spark, to).collect()}
    assert got == {1: ("a", None), 2: (None, True)}


def test_empty_table_and_nested_rows(spark, tmp_path):
    to = str(tmp_path / "s")
    kind = "k string, s struct<a:array<struct<b:int>>>"
    store.upsert(spark.createDataFrame([], kind), to, "k")
    assert store.read(spark, to).count() == 0
    store.upsert(spark.createDataFrame([("x", ([(1,), (2,)],)), ("x", ([(1,), (2,)],))], kind), to, "k")
    assert [r["s"]["a"][1]["b"] for r in store.read(spark, to).collect()] == [2]
