"""Embedding near-dedup with a pivot-permutation index.

Pivots are reference vectors drawn from the table (a bounded sample: a power of two near 4 sqrt(n), at
most ``MOST_PIVOTS``, less those near another pivot). Every distinct vector is described by its nearest pivots
in order and stands in the inverted list of each. A list first counts, for each two members, the pivots
that both have; pairs with ``SHARED`` or more are retrieved, once, in the list of the first pivot, in number, that
they share; and only these are verified by their cosine in double precision. No pair that was verified is given up.

How many nearest pivots describe a vector follows their number (``described_by``): the finer the cells, the
more of them, so that recall holds as the table grows.

No pair leaves a list: a list gives each member the number of its links and a tie to the least member of
its part. A list of over ``SPLIT`` members is parted by the second shared pivot. What still has over ``BLOCK``
members is cut into blocks, and each two blocks meet in a task of their own, so a group of near copies never
lands in one task (its comparisons do grow with its square: the number of direct links of each vector is
asked for). Equal vectors are one entry with a number of copies.

Recall, measured against brute force by this module's own functions on pairs at cosine 0.902: see the README.

Defined results: a vector that is null, empty, zero, or has null or non-finite parts links with nothing
and is its own component. Vectors of different length never link. Repeated rows are separate vectors. A
null id counts as a link of others but names no component unless alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stored
from .graph import components

LEAST = 0.9
SHARED = 2
#: Pivots at this cosine or more to one already taken are left out.
APART = 0.8
FEWEST_PIVOTS, MOST_PIVOTS = 64, 16384
#: Members of a list that meet in one task, and members over which a list is parted by a second pivot.
BLOCK, SPLIT = 1024, 16 * 1024
SEED = 4


def described_by(pivots: int) -> int:
    """How many nearest pivots describe a vector: 10 of up to 256, 2 more for each time their number doubles (22 of 16,384)."""
    return min(pivots, max(10, 2 * math.ceil(math.log2(max(pivots, 1))) - 6))


def _usable(v: str) -> str:
    finite = "x is not null and not isnan(x) and abs(x) < double('infinity')"
    return f"{v} is not null and forall({v}, x -> {finite}) and exists({v}, x -> x <> 0)"


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision (scaled first, so that no square overflows)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    v = flat.reshape(len(column), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def thinned(unit: np.ndarray, least: float) -> np.ndarray:
    """The rows that are under ``least`` to every row kept before: pivots in one dense group would part its members."""
    kept, n = np.empty_like(unit), 0
    for v in unit:
        if not n or (kept[:n] @ v).max() < least:
            kept[n] = v
            n += 1
    return kept[:n]


def nearest_pivots(unit: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """The numbers of each row's ``k`` nearest pivots, nearest first."""
    near = unit @ pivots.T
    top = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < len(pivots) else np.tile(np.arange(k), (len(near), 1))
    return np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable"), 1).astype(np.int32)


def retrieved(a: np.ndarray, b: np.ndarray, pivot: int, second: int, shared: int) -> np.ndarray:
    """For rows of pivot lists, which pairs (of a row of ``a`` and one of ``b``) this list retrieves.

    Both have ``pivot``. They must share ``shared`` pivots or more and none before ``pivot``; in a list parted
    by a second pivot also none between the two. Counts come from products of the incidence of the lists.
    """
    names, place = np.unique(np.concatenate([a.ravel(), b.ravel()]), return_inverse=True)

    def incidence(own: np.ndarray, at: np.ndarray, keep: np.ndarray) -> np.ndarray:
        out = np.zeros((len(own), len(names)), np.float32)
        out[np.repeat(np.arange(len(own)), own.shape[1]), at] = 1
        return out[:, keep]

    at_a, at_b = place.ravel()[: a.size], place.ravel()[a.size :]
    ok = np.ones((len(a), len(b)), bool)
    before = (names < pivot) | ((names > pivot) & (names < second))
    if before.any():
        ok = incidence(a, at_a, before) @ incidence(b, at_b, before).T == 0
    if shared > (1 if second < 0 else 2):
        ok &= incidence(a, at_a, ~before) @ incidence(b, at_b, ~before).T >= shared
    return ok


def _meet(t: pa.Table, least: float, shared: int) -> pa.Table:
    """One list, or two blocks of one: (cid, n, tie) for members with links."""
    pivot, second, low, high = (t[c][0].as_py() for c in ("pivot", "second", "low", "high"))
    cid, copies, block = (t[c].to_numpy() for c in ("cid", "copies", "block"))
    own = _matrix(t["nearest"])
    unit = _unit(pa.concat_arrays(t["v"].chunks) if t["v"].num_chunks != 1 else t["v"].chunk(0))
    left = np.flatnonzero(block == low)
    right = left if low == high else np.flatnonzero(block == high)
    ok = retrieved(own[left], own[right], pivot, second, shared)
    if low == high:
        ok &= np.arange(len(left))[:, None] < np.arange(len(right))
    if ok.mean() > 0.05:  # most pairs: their cosines as one product
        i, j = np.nonzero(ok & (unit[left] @ unit[right].T >= least))
    else:
        i, j = np.nonzero(ok)
        good = np.zeros(len(i), bool)
        for at in range(0, len(i), 1 << 14):
            part = slice(at, at + (1 << 14))
            good[part] = np.einsum("ij,ij->i", unit[left[i[part]]], unit[right[j[part]]]) >= least
        i, j = i[good], j[good]
    i, j = left[i], right[j]
    n = np.bincount(i, copies[j], len(cid)) + np.bincount(j, copies[i], len(cid))
    tie = cid.copy()
    while True:
        before = tie.copy()
        low_ = np.minimum(tie[i], tie[j])
        np.minimum.at(tie, i, low_)
        np.minimum.at(tie, j, low_)
        if (tie == before).all():
            break
    at = np.flatnonzero(n)
    return pa.table({"cid": pa.array(cid[at], pa.int64()), "n": pa.array(n[at].astype(np.int64)), "tie": pa.array(tie[at], pa.int64())})


def choose_pivots(classes: DataFrame, n: int) -> np.ndarray:
    """Unit vectors drawn from ``classes`` (cid, v): a power of two near 4 sqrt(n), thinned."""
    wanted = min(MOST_PIVOTS, max(FEWEST_PIVOTS, 1 << math.ceil(math.log2(4 * math.sqrt(n)))))
    drawn = classes.orderBy(F.xxhash64(F.lit(SEED), "v"), "cid").limit(wanted).select("v").collect()  # at most MOST_PIVOTS
    return thinned(_unit(pa.array([r[0] for r in drawn], pa.list_(pa.float64()))), APART)


def _linked(classes: DataFrame, chosen: np.ndarray, least: float, shared: int) -> DataFrame:
    """(cid, n, tie) over all lists for stored ``classes`` (cid, v, copies) of one length."""
    pivots = classes.sparkSession.sparkContext.broadcast(chosen)
    k = described_by(len(chosen))
    shared = min(shared, k)
    kind = classes.schema["v"].dataType.simpleString()

    def describe(batches):
        for b in batches:
            top = nearest_pivots(_unit(b.column(1)), pivots.value, k)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, len(top) * k + 1, k, dtype=np.int32)), pa.array(top.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), flat], names=["cid", "v", "copies", "nearest"])

    described = stored(map_arrow(classes.select("cid", "v", "copies"), describe, f"cid bigint, v {kind}, copies bigint, nearest array<int>"), "pivots")
    lists = described.select("cid", F.posexplode("nearest").alias("rank", "pivot"), "nearest")
    sizes = lists.groupBy("pivot").agg(F.count("*").alias("members"))
    # at most a row for each pivot, so at most MOST_PIVOTS
    placed = lists.join(F.broadcast(sizes), "pivot").withColumn("large", (F.col("members") > SPLIT) & F.lit(shared > 1))
    whole = placed.where("not large").select("cid", "pivot", F.lit(-1).alias("second"), "members")
    after = F.filter("nearest", lambda q: q > F.col("pivot"))
    parted = placed.where("large").select("cid", "pivot", F.explode(after).alias("second"))
    counted = parted.groupBy("pivot", "second").agg(F.count("*").alias("members"))
    entries = whole.unionByName(parted.join(counted, ["pivot", "second"]))
    cuts = F.ceil(F.col("members") / BLOCK).cast("int")
    entries = entries.withColumn("cuts", cuts).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("cuts")).cast("int"))
    met = entries.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    met = met.select("cid", "pivot", "second", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block")
    met = met.join(described, "cid")
    return met.groupBy("pivot", "second", "low", "high").applyInArrow(lambda t: _meet(t, least, shared), "cid bigint, n bigint, tie bigint")


def near_duplicates(vectors: DataFrame, least: float = LEAST, shared: int = SHARED, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each row of ``vectors``: id, n_links, component_id, kept."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("v"))
    good = rows.where(_usable("v"))
    classes = good.groupBy("v").agg(F.count("*").alias("copies"), F.min("id").alias("least_id"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "vectors")
    sizes = classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()  # one row for each vector length
    links = None
    for d, n in sizes:
        own = classes.where(F.size("v") == d)
        part = _linked(own, choose_pivots(own, n), least, shared)
        links = part if links is None else links.unionAll(part)
    if links is None:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = stored(links, "links")
    counts = links.groupBy("cid").agg(F.sum("n").alias("n"))
    comp = components(links.select(F.col("cid").alias("u"), F.col("tie").alias("v")))
    tied = classes.join(counts, "cid", "left").join(comp.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    names = tied.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of = tied.join(names, "component").select(F.col("v").alias("_v"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    found = good.join(of, F.col("v") == F.col("_v")).select("id", "n_links", F.coalesce("component_id", "id").alias("component_id"))
    rest = rows.where(f"not coalesce({_usable('v')}, false)").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return found.unionAll(rest).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()))


def op4_pivot_near_dedup(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors).withColumnRenamed("id", "vec_id")
