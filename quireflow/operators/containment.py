"""Which of very many texts stand in which of very many others, by an inverted index of rare grams.

Each needle is looked up by one gram of ``GRAM`` characters (a shorter needle by itself): the one whose bucket of
a histogram of the hays' grams is smallest, so a gram that the hays share is taken only by a needle that has no
other. The hays are read once more and send, with their text, the grams that may be a needle's; a bit table
of the chosen grams says which. Grams meet needles by an equi-join, and ``instr`` over the hay's text decides.

What goes to all executors has a fixed bound: the histogram (half a megabyte for each length of gram, eight at most)
and the bit table (at most ``1 << MOST_BITS`` bits). Neither needles nor hays go through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch

GRAM = 8
#: Bits of a histogram's bucket, and of the smallest and the largest bit table (2 and 32 MB).
HISTOGRAM_BITS, LEAST_BITS, MOST_BITS = 16, 24, 28


def gram_hashes(text: str, n: int) -> np.ndarray:
    """64 bits for each run of ``n`` characters, in order."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if len(codes) < n:
        return np.empty(0, np.uint64)
    h = np.zeros(len(codes) - n + 1, np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(codes) - n + 1 + i]
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _top(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _histogram(hays: DataFrame, sizes: list[int]) -> dict[int, np.ndarray]:
    """For each length of gram how many grams of all hays fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {n: np.zeros(1 << HISTOGRAM_BITS, np.int64) for n in sizes}
        for b in batches:
            for text in b.column(0):
                for n, c in counts.items():
                    c += np.bincount(_top(gram_hashes(text.as_py(), n), HISTOGRAM_BITS), minlength=len(c))
        for n, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n, np.int32)), pa.array(at.astype(np.int32)), pa.array(c[at])], names=["size", "bucket", "n"])

    rows = hays.select("text").mapInArrow(run, "size int, bucket int, n bigint").groupBy("size", "bucket").agg(F.sum("n").alias("n"))
    found = rows.toArrow()  # at most 1 << HISTOGRAM_BITS rows for each length
    out = {n: np.zeros(1 << HISTOGRAM_BITS, np.int64) for n in sizes}
    size, bucket, n = (found.column(i).to_numpy() for i in range(3))
    for k, c in out.items():
        c[bucket[size == k]] = n[size == k]
    return out


def _chosen(texts: DataFrame, histogram: dict[int, np.ndarray]) -> DataFrame:
    """(needle, hash): the rarest gram of each needle, the first of equals."""
    shared = texts.sparkSession.sparkContext.broadcast(histogram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = []
            for text in b.column(0).to_pylist():
                n = min(len(text), GRAM)
                h = gram_hashes(text, n)
                hashes.append(int(h[np.argmin(shared.value[n][_top(h, HISTOGRAM_BITS)])]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(hashes, np.uint64).view(np.int64))], names=["needle", "hash"])

    return texts.select("needle").mapInArrow(run, "needle string, hash bigint")


def _bit_table(chosen: DataFrame, bits: int) -> np.ndarray:
    """One bit for each value of the first ``bits`` bits of a hash."""
    slot = F.shiftrightunsigned("hash", 64 - bits) + 1  # the bitmap functions count from 1
    parts = chosen.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros(1 << bits, bool)
    for part, packed in zip(*[c.to_pylist() for c in parts.toArrow().columns]):  # 4 KB each
        some = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little")
        at = (part - 1) * 32768
        out[at : at + len(some)] = some[: max(0, len(out) - at)]
    return np.packbits(out)


def located(needles: DataFrame, hays: DataFrame) -> DataFrame:
    """(needle, hay, at): ``needle`` (a text of ``needles``) stands in the text of the row of ``hays`` (hay, text) first at ``at`` (1 is the start).

    ``needles`` (needle) are distinct and not empty; each hay row counts for itself, whatever its id. Tables made on the way
    are in the shared folder and go when the application ends.
    """
    spark = needles.sparkSession
    to = scratch(spark, "containment")
    length = F.least(F.length("needle"), F.lit(GRAM))
    sizes = sorted(r[0] for r in needles.select(length).distinct().collect())  # at most GRAM numbers
    kind = hays.schema["hay"].dataType.simpleString()
    if not sizes:
        return spark.createDataFrame([], f"needle string, hay {kind}, at int")
    _chosen(needles, _histogram(hays, sizes)).write.parquet(f"{to}/chosen")
    chosen = spark.read.parquet(f"{to}/chosen")
    bits = min(MOST_BITS, max(LEAST_BITS, (64 * chosen.count()).bit_length()))
    shared = spark.sparkContext.broadcast(_bit_table(chosen, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, row = shared.value, TaskContext.get().partitionId() << 33
        for b in batches:
            at, rows, found = [], [], []
            for i, text in enumerate(b.column(1)):
                each = []
                for n in sizes:
                    h = gram_hashes(text.as_py(), n)
                    slot = _top(h, bits)
                    each.append(h[(table[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)])
                h = np.unique(np.concatenate(each))
                if len(h):
                    at.append(i)
                    rows.append(row + i)
                    found.append(h.view(np.int64))
            row += b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), b.column(0).take(pa.array(at, pa.int64())), b.column(1).take(pa.array(at, pa.int64())), pa.array(found, pa.list_(pa.int64()))], names=["row", "hay", "text", "hashes"])

    hays.select("hay", "text").mapInArrow(run, f"row bigint, hay {kind}, text string, hashes array<bigint>").write.parquet(f"{to}/hits")
    hits = spark.read.parquet(f"{to}/hits")
    met = hits.select("row", F.explode("hashes").alias("hash")).join(chosen, "hash").select("row", "needle")
    found = met.join(hits.select("row", "hay", "text"), "row").select("needle", "hay", F.expr("instr(text, needle)").alias("at"))
    return found.where("at > 0")
