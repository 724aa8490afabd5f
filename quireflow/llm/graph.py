"""Connected components by alternating large-star and small-star rounds, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored


def _minima(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): component is the smallest node reachable.

    Each round writes its edges to the shared folder, so lost executors cost at most one round. The
    driver sees one checksum a round. A node with very many neighbours is reduced by partial
    aggregation, and its join is one that Spark can split.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    last = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == last or not mark[0]:
            break
        last = mark
        # large-star: neighbours above u go to the smallest of u and its neighbours
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.where("v > u").join(_minima(both), "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        # small-star: u and its neighbours below go to the smallest of them
        joined = large.join(_minima(large), "u")
        small = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(joined.select("u", F.col("m").alias("v")))
        now, before = stored(small.distinct(), "edges"), now
        dropped(before)
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionAll(now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component")))
