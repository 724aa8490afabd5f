"""Near-duplicate documents by similarity: SimHash and MinHash bands find candidates, exact Jaccard decides.

The similarity of two documents is the Jaccard of their sets of distinct five-word shingles (A-Z
lower-cased). Candidates come from two indexes. SimHash fingerprints of the sets, by ``simhash.links`` (segments,
Hamming balls, verified distances), find near copies. At 0.8 two fingerprints of 64 bits differ in about ten
bits, which no small ball reaches, so what is less alike is found by a signature of ``BANDS`` bands of ``ROWS`` minima:
two documents of similarity s meet in a band with chance 1 - (1 - s^ROWS)^BANDS, 99.98 % at 0.8, whatever the
number of documents. Documents that share no shingle don't meet, so no width has to follow the size of the table.

Documents joined by these, directly or through others, form a group. A group's texts meet in one task, or
a large one's in a task for each two blocks of it. There every two candidates of one of the kinds are
compared by exact Jaccard of their shingles' 64-bit hashes, and only ``similarity`` or more is a link.
Parts grow from a member by comparing with members that belong to none yet, so thousands of near copies
cost few rounds, not the square, and no link is lost. Many unlike documents that share bands do cost the
square of their number in comparisons.

Defined results: texts without a word link only with nothing (equal ones are copies). A null text is empty.
Equal texts are one class however often they occur. Rows equal in id and text are copies of each other.
Columns of the input may have any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_arrow, stored, words_of
from .exchange import hashes, mixed
from .graph import components
from .simhash import links

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 36, 7
#: Distinct shingles that one block of a group may hold, about.
BLOCK = 2_000_000
#: Bits in which fingerprints of candidates may differ.
RADIUS = 2

_rng = np.random.default_rng(42)
_FLIP = _rng.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32)
_TIMES = _rng.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32) | np.uint32(1)


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """64 bits of each distinct word shingle, sorted; fewer words than a shingle make one of all, no words none."""
    words = [w.lower() for w in words_of(text)]  # of bytes, lower() changes A-Z only
    if not words:
        return np.empty(0, np.uint64)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    return np.unique(hashes(grams))


def bands_of(own: np.ndarray) -> np.ndarray:
    """64 bits for each band of the signature of a set that isn't empty."""
    low = (own ^ (own >> np.uint64(32))).astype(np.uint32)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(low), 2048):
        np.minimum(least, ((low[at : at + 2048] ^ _FLIP) * _TIMES).min(axis=1), out=least)
    key = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = mixed(key ^ column.astype(np.uint64), 1)
    return key


def fingerprint_of(own: np.ndarray) -> int:
    """SimHash of a set of 64-bit hashes: each bit is 1 if set in over half of them."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(own), 1 << 16):
        ones += np.unpackbits(own[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(own)).tobytes(), "big", signed=True)


def linked(sets: list[np.ndarray], bands: np.ndarray, fps: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """For each set (sorted, distinct, not empty) the least one, by place, that links connect it to.

    A link is an exact Jaccard of ``similarity`` or more between two that share a band, or whose fingerprints are near.
    """
    label, left = np.arange(len(sets)), np.arange(len(sets))
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    begin = np.cumsum(size) - size
    number = np.unique(np.concatenate(sets), return_inverse=True)[1] if sets else np.empty(0, np.int64)
    mark = np.zeros(len(number), bool)
    while len(left):
        root, left = int(left[0]), left[1:]
        front = [root]
        while front and len(left):
            x = front.pop()
            near = (bands[left] == bands[x]).any(axis=1) | (np.bitwise_count(fps[left] ^ fps[x]) <= RADIUS)
            near &= np.minimum(size[left], size[x]) / np.maximum(size[left], size[x]) >= similarity
            own = number[begin[x] : begin[x] + size[x]]
            mark[own] = True
            at = np.flatnonzero(near)
            for i in range(0, len(at), 1024):
                some = left[at[i : i + 1024]]
                n = size[some]
                first = np.cumsum(n) - n
                both = np.add.reduceat(mark[number[np.repeat(begin[some] - first, n) + np.arange(int(n.sum()))]], first, dtype=np.int64)
                near[at[i : i + 1024]] = both / (n + size[x] - both) >= similarity
            mark[own] = False
            found, left = left[near], left[~near]
            label[found] = root
            front += found.tolist()
    return label


def duplicate_classes(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each distinct (id, text) of ``docs``: id, digest (MD5 of the text), class_id, stays.

    ``class_id`` is the smallest id that links reach; of each class the row of the smallest id, then digest, stays.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            own = [shingles(t.as_py(), shingle) for t in b.column(2)]
            bands = [bands_of(s).view(np.int64) if len(s) else None for s in own]
            fps = [fingerprint_of(s) if len(s) else 0 for s in own]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(bands, pa.list_(pa.int64())), pa.array(fps, pa.int64()), pa.array(list(map(len, own)), pa.int64())], names=["id", "digest", "bands", "fp", "size"]
            )

    texts = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"), F.col(text).alias("text"))
    rows = stored(map_arrow(texts, run, f"id {kind}, digest string, bands array<bigint>, fp bigint, size bigint"), "bands")
    classes = rows.groupBy("digest").agg(F.first("bands").alias("bands"), F.first("fp").alias("fp"), F.first("size").alias("size")).withColumn("node", F.monotonically_increasing_id())
    classes = stored(classes, "band-classes")
    keys = classes.where("size > 0").select("node", F.explode("bands").alias("key"))
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    shared = keys.hint("merge").join(hubs, "key").where("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v"))
    first = stored(classes.where("size > 0").groupBy("fp").agg(F.min("node").alias("hub")), "fingerprints")
    alike = classes.where("size > 0").join(first, "fp").where("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v"))
    near = links(first, RADIUS).join(first.select(F.col("fp").alias("u"), F.col("hub").alias("hu")), "u").join(first.select(F.col("fp").alias("v"), F.col("hub").alias("hv")), "v")
    met = components(shared.unionAll(alike).unionAll(near.select("hu", "hv")))

    def tie(t: pa.Table) -> pa.Table:
        node = t["node"].to_numpy()
        order = np.argsort(node, kind="stable")
        node = node[order]
        bands = t["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)[order]
        label = linked([shingles(t["text"][int(i)].as_py(), shingle) for i in order], bands, t["fp"].to_numpy()[order], similarity)
        at = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"u": pa.array(node[at], pa.int64()), "v": pa.array(node[label[at]], pa.int64())})

    members = stored(classes.join(met, "node"), "band-groups")
    cuts = members.groupBy("component").agg(F.ceil(F.sum("size") / F.lit(BLOCK)).cast("int").alias("cuts"))
    placed = members.join(cuts, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))).where("block <> with or cuts = 1")
    placed = placed.select("digest", "node", "bands", "fp", "component", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"))
    once = texts.join(members.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.first("text").alias("text"))
    comp = components(placed.join(once, "digest").groupBy("component", "low", "high").applyInArrow(tie, "u bigint, v bigint"))
    of = classes.select("digest", "node").join(comp, "node", "left").select("digest", F.coalesce("component", "node").alias("class"))
    known = rows.select("id", "digest").distinct().join(of, "digest")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest"))
    winners = known.groupBy("class").agg(first.alias("w")).select(F.col("class").alias("_class"), "w.*")
    winners = winners.select("_class", F.col("id").alias("class_id"), F.col("digest").alias("_digest"))
    out = known.join(winners, F.col("class") == F.col("_class"))
    return out.select("id", "digest", "class_id", (F.col("id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("_digest"))).alias("stays"))


def without_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, with their columns, of which one of each class stays."""
    key, i, d = (free_name(docs, n) for n in ("_text_digest", "_stays_id", "_stays_digest"))
    stay = duplicate_classes(docs, shingle, similarity, id_col, text).where("stays").select(F.col("id").alias(i), F.col("digest").alias(d))
    keyed = docs.withColumn(key, F.md5(F.coalesce(F.col(text), F.lit(""))))
    kept = keyed.join(stay, F.col(id_col).eqNullSafe(F.col(i)) & (F.col(key) == F.col(d)), "left_semi")
    return kept.dropDuplicates([id_col, key]).drop(key)
