"""SimHash near-dedup with multi-index hashing.

A fingerprint has ``bits`` bits over word shingles. To find all pairs of distinct fingerprints within
``radius``, each fingerprint is cut into segments; if a pair differs in at most r bits over m
segments, then some segment differs by at most floor(r / m) bits, and by the pigeonhole principle the
later segments may take one bit less (see ``balls``). The table holds every fingerprint under each of
its segment values; a probe enumerates the Hamming ball around each of its segments and fetches the
table's rows; complete distances are then verified.

A segment value shared by more than ``BUCKET`` distinct fingerprints would give the square of their
number. Such buckets, and the probes that reach them, take an exact way whose rows are linear in
the number of fingerprints: two fingerprints differ in at most r bits if and only if the balls of
radius ceil(r/2) and floor(r/2) around them share a value, so every fingerprint publishes the values
of its ball and all that publish one value are tied to the smallest. For r = 2 every such tie is a
link by itself; for r = 1 a value ties only to a fingerprint equal to it. No other radius but 0 is taken.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, stored, words_of
from .graph import components

SEED = 42
BUCKET = 64


def fingerprint(text: str | None, shingle: int = 3, seed: int = SEED) -> int:
    """64 bits: each is 1 if set in over half the XXH64 hashes of the word shingles (A-Z lower-cased).

    Repeats count. Fewer words than a shingle make one shingle of all; no words give zero.
    """
    words = [w.lower() for w in words_of(text)]  # of bytes, lower() changes A-Z only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_digest
    for at in range(0, n, 1 << 16):
        part = words[at : min(at + (1 << 16), n) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        raw = np.frombuffer(b"".join([digest(g, seed) for g in grams]), dtype=np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, fp bigint"

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["id", "fp"])

    return map_arrow(docs.select(id_col, text), run, schema)


def segments(bits: int, m: int) -> list[tuple[int, int]]:
    """(shift, width) of m segments of nearly equal width, lowest first."""
    widths = [bits // m + (i < bits % m) for i in range(m)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def balls(radius: int, m: int) -> list[int]:
    """The ball radius of each segment: r = m q + a, then q for the first a + 1 segments and q - 1 for the rest.

    If every one of the first a + 1 segments differed by over q bits and each other one by at least q,
    the whole would differ by at least (a + 1)(q + 1) + (m - a - 1) q = r + 1 bits.
    """
    q, a = divmod(radius, m)
    return [q if i <= a else q - 1 for i in range(m)]


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << i for i in at) for k in range(radius + 1) for at in combinations(range(width), k)]


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v - (1 << 64) if v >> 63 else v).cast("long") for v in values])


def links(fps: DataFrame, radius: int = 2, m: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(u, v) that tie all distinct fingerprints ``fp`` within ``radius`` of each other, transitively.

    Every row is a pair within ``radius``, or ties two that share a third within it in between.
    """
    parts = [(i, shift, width, r) for i, ((shift, width), r) in enumerate(zip(segments(64, m), balls(radius, m))) if r >= 0]
    fps = fps.select("fp").distinct()

    def value(shift: int, width: int) -> Column:
        return F.shiftrightunsigned(F.col("fp"), shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    table = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), value(s, w).alias("val")) for i, s, w, _ in parts])).alias("k")).select("fp", "k.seg", "k.val")
    def probed(i: int, shift: int, width: int, r: int) -> Column:
        return F.transform(_longs(_masks(width, r)), lambda x: F.struct(F.lit(i).alias("seg"), value(shift, width).bitwiseXOR(x).alias("val")))

    probes = fps.select(F.col("fp").alias("q"), F.explode(F.concat(*[probed(*p) for p in parts])).alias("k")).select("q", "k.seg", "k.val")
    sizes = table.groupBy("seg", "val").agg(F.count("*").alias("n"))
    # both sides are unfolded many times over, which size estimates don't see: no side may be broadcast
    light = table.hint("merge").join(sizes.where(F.col("n") <= bucket), ["seg", "val"])
    near = F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= radius
    found = probes.hint("merge").join(light, ["seg", "val"]).where((F.col("q") != F.col("fp")) & near)
    pairs = found.select(F.greatest("q", "fp").alias("u"), F.least("q", "fp").alias("v"))
    # whoever reaches a heavy bucket, its own included
    reach = probes.hint("merge").join(sizes.where(F.col("n") > bucket).select("seg", "val"), ["seg", "val"]).select(F.col("q").alias("fp")).distinct()
    ball = F.transform(_longs(_masks(64, (radius + 1) // 2)), lambda x: F.col("fp").bitwiseXOR(x))
    published = reach.select("fp", F.explode(ball).alias("key"))
    if radius == 1:  # one ball is of radius 0: a value ties to the fingerprint that it is
        hub = fps.select(F.col("fp").alias("key"), F.col("fp").alias("hub"))
    else:
        hub = published.groupBy("key").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    ties = published.hint("merge").join(hub, "key").where("fp <> hub").select(F.col("fp").alias("u"), F.col("hub").alias("v"))
    return pairs.unionAll(ties).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, fp (long), component_id.

    Rows of equal fingerprint are one class, whatever their number; only distinct fingerprints enter
    the index and the graph. ``component_id`` is the smallest id reachable by links. Null and empty
    texts have fingerprint zero and link like any other. A null id takes part and is never the smallest
    unless its component has no other. Radius at most 2.
    """
    if not 0 <= radius <= 2:
        raise ValueError("radius: 0, 1 or 2")
    rows = stored(fingerprints(docs, shingle, id_col, text), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-classes")
    comp = components(links(classes, radius))
    tied = classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = tied.groupBy("component").agg(F.min("least").alias("component_id"))
    of = tied.join(names, "component").select("fp", "component_id")
    return rows.join(of, "fp").select("id", "fp", "component_id")


def op2_simhash_near_dedup(docs: DataFrame) -> DataFrame:
    out = near_duplicates(docs)
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
