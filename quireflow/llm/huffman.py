"""Token ids in files: canonical length-limited Huffman code over the ids' counts in the whole corpus.

A written set is a folder with two tables. ``codebook``: (id, length) of every id that occurs; codes
are canonical (by length, then id), of at most ``MAX_BITS`` bits. ``blocks``: one row for each block of
whole documents (about ``BLOCK_IDS`` ids), in ascending document order over the files: ``part`` and
``block`` (its place), ``start`` (ids before it in its part), ``doc_ids`` and ``lengths``, ``payload``
(the codes, most significant bit first) and ``checkpoints`` (bit offsets of every ``EVERY``-th id). A
block is decoded by itself: the stretches between checkpoints are lanes that step through one lookup
table together.

The container is Parquet, written by Spark, so sets go to any store that Spark writes, and a task that is
lost is written again.

Defined results: a null or empty text has the end id only. Rows with a null id come first. Rows with
equal id keep the order in which they were encoded. An empty table writes no block.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import kept
from .common import gone_at_exit, map_arrow, partitions, shared_dir, stored, tokenizer_path
from .run_table import TableEncoder

MAX_BITS = 20
BLOCK_IDS = 1 << 16
EVERY = 128
#: Blocks that are decoded together.
DECODED = 16
END_ID = 1


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits for positive ``counts``, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.uint8)
    if n > 1 << most:
        raise ValueError(f"{n} symbols don't fit codes of {most} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64) if counts.sum() > 1 << 62 else counts[order].astype(np.int64)
    now, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(most - 1):
        pairs = now[: len(now) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        place = np.argsort(both, kind="stable")
        now = both[place]
        is_leaf.append(place < n)
    lengths, need = np.zeros(n, np.uint8), 2 * n - 2
    for leaf in reversed(is_leaf):
        here = int(leaf[:need].sum())
        lengths[:here] += 1
        need = 2 * (need - here)
    out = np.empty(n, np.uint8)
    out[order] = lengths
    return out


class Code:
    """Canonical codes for ``ids`` with ``lengths``."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.bits = int(self.lengths.max()) if len(ids) else 1
        size = 1 << (self.bits - self.lengths)
        start = np.cumsum(size) - size  # each code's share of the table, as canonical codes count up
        top = int(self.ids.max()) + 1 if len(ids) else 1
        self.code, self.length = np.zeros(top, np.uint64), np.zeros(top, np.int64)
        self.code[self.ids] = (start >> (self.bits - self.lengths)).astype(np.uint64)
        self.length[self.ids] = self.lengths
        self.size, self._table = size, None

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """For every value of the next ``bits`` bits, the id and its length."""
        if self._table is None:
            rest = (1 << self.bits) - int(self.size.sum())
            self._table = (
                np.concatenate([np.repeat(self.ids, self.size), np.zeros(rest, np.int64)]).astype(np.uint32),
                np.concatenate([np.repeat(self.lengths, self.size), np.ones(rest, np.int64)]).astype(np.uint8),
            )
        return self._table

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The payload and the bit offset of every ``EVERY``-th id."""
        if not len(ids):
            return b"", np.empty(0, np.uint64)
        length = self.length[ids]
        end = np.cumsum(length)
        at = end - length
        value = self.code[ids] << (64 - (at & 31) - length).astype(np.uint64)
        word = at >> 5
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out = np.zeros(int(word[-1]) + 3, np.uint64)
        out[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
        out[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
        return out.astype(">u4").tobytes(), at[::EVERY].astype(np.uint64)

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        return self.decode_blocks([(payload, checkpoints, n)])[0]

    def decode_blocks(self, blocks: list[tuple[bytes, np.ndarray, int]]) -> list[np.ndarray]:
        """The ids of independent blocks (payload, checkpoints, number): the lanes of all of them step together."""
        ids, lengths = self.table()
        words = np.frombuffer(b"".join(p for p, _, _ in blocks), ">u4").astype(np.uint64)
        base = np.cumsum([0, *(len(p) * 8 for p, _, _ in blocks)])[:-1]
        at = np.concatenate([m.astype(np.int64) + b for (_, m, _), b in zip(blocks, base.tolist())])
        if not len(at):
            return [np.empty(0, np.uint32) for _ in blocks]
        out = np.zeros((EVERY, len(at)), np.uint32)
        shift, mask = np.uint64(64 - self.bits), np.uint64((1 << self.bits) - 1)
        last = len(words) - 2
        for step in range(EVERY):
            w = np.minimum(at >> 5, last)  # a block's last lane runs past its end, into bits that nobody reads
            peek = (words[w] << np.uint64(32) | words[w + 1]) << (at & 31).astype(np.uint64) >> shift & mask
            out[step] = ids[peek]
            at += lengths[peek]
        flat, lane, result = out.T.ravel(), 0, []
        for _, m, n in blocks:
            result.append(flat[lane * EVERY : lane * EVERY + n])
            lane += len(m)
        return result


def encode_ids(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """(id, ids) with the ids of each text, by the tokenizers library, and the end id, as little-endian 16 or 32-bit integers."""
    from tokenizers import Tokenizer

    with open(path or tokenizer_path(), encoding="utf-8") as f:
        spec = f.read()
    kind = "<u2" if Tokenizer.from_str(spec).get_vocab_size() <= 1 << 16 else "<u4"
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    width = int(kind[2])
    end = int(end_id).to_bytes(width, "little")

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = kept(("table", shared.value), lambda: TableEncoder(shared.value))
        for b in batches:
            flat, ends = encoder.encode(b.column(1))
            raw, at = flat.astype(kind).tobytes(), [0, *(ends * width).tolist()]
            ids = [raw[i:j] + end for i, j in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array([width] * len(ids), pa.int32())], names=["id", "ids", "width"])

    return map_arrow(docs.select(id_col, text), run, f"id {docs.schema[id_col].dataType.simpleString()}, ids binary, width int")


def id_counts(encoded: DataFrame) -> list[tuple[int, int]]:
    """How often each id occurs in all documents: at most one row for each id of the vocabulary comes to the driver."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            n = np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), f"<u{b.column(1)[0].as_py()}"), minlength=len(total))
            n[: len(total)] += total
            total = n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])

    rows = map_arrow(encoded.select("ids", "width"), run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return sorted((r[0], r[1]) for r in rows.collect())


_BLOCKS = "part int, block int, start bigint, doc_ids array<{kind}>, lengths binary, n_ids bigint, payload binary, checkpoints binary"


def write_ids(docs: DataFrame, to: str, path: str | None = None, id_col: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Encode ``docs`` and write the set ``to`` a folder that all executors reach."""
    spark = docs.sparkSession
    rows = stored(encode_ids(docs, path, id_col, text, end_id).withColumn("row", F.monotonically_increasing_id()), "ids")
    counts = id_counts(rows)
    ids, n = np.array([c[0] for c in counts], np.int64), np.array([c[1] for c in counts], np.int64)
    lengths = code_lengths(n)
    spark.createDataFrame([(int(i), int(k)) for i, k in zip(ids, lengths)], "id bigint, length int").coalesce(1).write.parquet(f"{to}/codebook")
    kind = docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast((ids, lengths))

    def run(batches):
        code = Code(*shared.value)
        part, block, start = TaskContext.get().partitionId(), 0, 0
        held, docs_, total = [], [], 0

        def flush():
            payload, marks = code.encode(np.concatenate(held))
            lens = np.array([len(h) for h in held], "<u4").tobytes()
            columns = [[part], [block], [start], [docs_], [lens], [total], [payload], [marks.astype("<u8").tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        names = ["part", "block", "start", "doc_ids", "lengths", "n_ids", "payload", "checkpoints"]
        types = None
        for b in batches:
            types = types or [pa.int32(), pa.int32(), pa.int64(), pa.list_(b.schema.field(0).type), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
            for i, x, w in zip(b.column(0), b.column(1), b.column(2)):
                held.append(np.frombuffer(x.as_py(), f"<u{w.as_py()}"))
                docs_.append(i.as_py())
                total += len(held[-1])
                if total >= BLOCK_IDS:
                    yield flush()
                    block, start, held, docs_, total = block + 1, start + total, [], [], 0
        if held:
            yield flush()

    ordered = rows.repartitionByRange(partitions(spark), F.col("id").asc_nulls_first(), F.col("row")).sortWithinPartitions(F.col("id").asc_nulls_first(), "row")
    map_arrow(ordered.select("id", "ids", "width"), run, _BLOCKS.format(kind=kind)).write.parquet(f"{to}/blocks")


def read_ids(spark: SparkSession, at: str, with_ids: bool = False) -> DataFrame:
    """One row for each document of a written set: id, start, n_tokens, ids_crc32; ``with_ids`` adds ids (binary, 32-bit)."""
    book = spark.read.parquet(f"{at}/codebook").collect()  # at most one row for each id of the vocabulary
    shared = spark.sparkContext.broadcast((np.array([r[0] for r in book], np.int64), np.array([r[1] for r in book], np.int64)))
    blocks = spark.read.parquet(f"{at}/blocks")
    # one row for each partition written
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = sizes.select("part", before.alias("before"))
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        code = Code(*shared.value)
        for b in batches:
            kinds = b.schema.field("doc_ids").type.value_type
            for k in range(0, b.num_rows, DECODED):
                rows = b.slice(k, DECODED).to_pylist()
                decoded = code.decode_blocks([(r["payload"], np.frombuffer(r["checkpoints"], "<u8"), r["n_ids"]) for r in rows])
                for r, ids in zip(rows, decoded):
                    ids = ids.astype("<u4")
                    lens = np.frombuffer(r["lengths"], "<u4").astype(np.int64)
                    ends = np.cumsum(lens)
                    own = [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), lens.tolist())]
                    columns = [
                        pa.array([r["part"]] * len(own), pa.int32()), pa.array(r["doc_ids"], kinds), pa.array(r["start"] + ends - lens, pa.int64()),
                        pa.array(lens, pa.int64()), pa.array([zlib.crc32(x) for x in own], pa.int64()),
                    ]
                    if with_ids:
                        columns.append(pa.array(own, pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=["part", "id", "first", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    more = ", ids binary" if with_ids else ""
    rows = map_arrow(blocks.select("part", "block", "start", "doc_ids", "lengths", "n_ids", "payload", "checkpoints"), run, f"part int, id {kind}, first bigint, n_tokens bigint, ids_crc32 bigint{more}")
    out = rows.join(shift, "part")
    return out.select("id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op6_huffman_ids(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    to = f"{shared_dir(spark)}/huffman-{uuid.uuid4().hex}"
    write_ids(docs, to)
    gone_at_exit(spark, to)
    return read_ids(spark, to).withColumnRenamed("id", "doc_id")
