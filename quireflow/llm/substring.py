"""Substring dedup: words covered by a window of 35 words that also starts elsewhere go.

A count-min prefilter comes first. A window's key is the least hash among its 8-word grams (its
minimiser), so equal windows have equal keys at equal offsets, and the number of places where a key is
the least of some window is never under the number of places where any window with that key starts.
So counting keys' places overestimates, never underestimates, how often a window occurs. Each chunk of
documents sketches its keys' places in ``DEPTH`` rows of ``width`` counters saturating at 2; the sketches of all
chunks are merged, each range of counters in one task, and a chunk learns which of its counters reached 2. A
window is estimated repeated if its counter did in every row: none that repeats is lost. The second pass
groups exactly these windows, by 128-bit hashes of their word sequences over 128-bit hashes of words (two
independent halves of XXH3-128, each rolled for itself): a chunk asks once for each distinct window, so a
passage in half of all documents is one entry for each chunk, never a group of all its places.

Sizes. The width is chosen from the input: the power of two from ``COUNTERS`` counters for each key that its
bytes should give, so a key that doesn't repeat is taken for one that does with a chance of about
``COUNTERS ** -DEPTH``. A counter takes a byte while its range is merged; a range has ``RANGE`` of them at most. Chunks have about
``CHUNK_BYTES`` of text, and buckets about ``BUCKET_BYTES`` of requests, whatever the size of the corpus.
Nothing is broadcast, and the documents are exchanged once: the three stages that read them share that exchange.

Defined results: a null or empty text has no words. A document of under 35 words has no window and
keeps all. Equal documents of 35 words or more lose all words, each of them. Repeated rows count as
documents. Windows are judged on the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import partitions, stored, words_of
from .exchange import blocks, chunked, cuts, mixed, pack, pack_bits, parts_for, spread, unpack, unpack_bits

WINDOW = 35
GRAM = 8
DEPTH = 2
#: Counters in a row of the sketch for each key; bytes of text that give a key, about (14 words).
COUNTERS, KEY_BYTES = 16, 84
#: Counters of a range (a byte each while merged); text in a chunk; requests in a bucket.
RANGE, CHUNK_BYTES, BUCKET_BYTES = 1 << 26, 32 << 20, 64 << 20
#: What a task should read, if the session's shuffle partitions would give it more.
TASK_BYTES = 256 << 20
P1, P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _inverse(p: np.uint64) -> int:
    return pow(int(p), -1, 1 << 64)


def _powers(p: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, p, np.uint64)]), dtype=np.uint64)


def rolling(v: np.ndarray, k: int, p: np.uint64) -> np.ndarray:
    """A polynomial hash modulo 2^64 of every k consecutive values."""
    n = len(v)
    if n < k:
        return np.empty(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(v * _powers(int(p), n), dtype=np.uint64)])
    return (sums[k:] - sums[:-k]) * _powers(_inverse(p), n - k + 1)


def _slide(a: np.ndarray, k: int, f) -> np.ndarray:
    """f (minimum or maximum) of every k consecutive values, by doubling."""
    size = 1
    while 2 * size <= k:
        a = f(a[:-size], a[size:])
        size *= 2
    return f(a[: len(a) - (k - size)], a[k - size :]) if size < k else a


class Block:
    """The windows of a run of documents: ``start`` (place in the run), ``key``, and keys' places."""

    def __init__(self, lens: np.ndarray, wide: np.ndarray, window: int):
        self.lens, self.wide, self.window = lens, wide, window
        h = np.ascontiguousarray(wide[:, 0])
        gram = min(GRAM, window)
        n = len(h) - window + 1
        if n <= 0:
            self.start, self.key, self.places = np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
            return
        ends = np.repeat(np.cumsum(lens), lens)  # end of the document of each word
        valid = np.arange(n) + window <= ends[:n]
        g = mixed(rolling(h, gram, P1), 1) | np.uint64(1)
        span = window - gram + 1
        least = np.where(valid, _slide(g, span, np.minimum), np.uint64(0))
        padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
        self.places = g[_slide(padded, span, np.maximum) == g]
        self.start = np.flatnonzero(valid)
        self.key = least[valid]

    def digests(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(at):
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        hi, lo = (rolling(np.ascontiguousarray(self.wide[:, i]), self.window, p) for i, p in ((0, P1), (1, P2)))
        return mixed(hi[at], 2), mixed(lo[at], 3)


def _cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The counter of each key in a row of 2^bits counters, as the top bits of a number."""
    return mixed(keys, 11 + row) & ~np.uint64((1 << (64 - bits)) - 1)


def width_bits(text_bytes: int) -> int:
    """log2 of the counters in a row for texts of so many bytes."""
    return max(16, (COUNTERS * text_bytes // KEY_BYTES).bit_length())


class Chunk:
    """All blocks of a chunk; they are made anew by each stage, in the same way."""

    def __init__(self, texts: pa.ChunkedArray, window: int, buckets: int, bits: int):
        self.blocks = [Block(lens, h, window) for lens, h in blocks(texts)]
        self.buckets, self.bits = buckets, bits
        self.window = window
        places = np.concatenate([b.places for b in self.blocks]) if self.blocks else np.empty(0, np.uint64)
        self.rows = [np.unique(_cells(places, r, bits), return_counts=True) for r in range(DEPTH)]

    def sketch(self) -> Iterator[tuple[int, int, bytes, bytes]]:
        """(bucket, row, cells, which of them count 2 or more here)."""
        for r, (cells, counts) in enumerate(self.rows):
            for bucket, (i, j) in enumerate(cuts(cells, self.buckets)):
                if j > i:
                    # numbers of counters, so few bytes each
                    yield bucket, r, pack(cells[i:j] >> np.uint64(64 - self.bits)), pack_bits(counts[i:j] > 1)

    def estimated(self, answers: dict[tuple[int, int], bytes]) -> list[np.ndarray]:
        """For each block the windows (numbers of its ``start``) estimated repeated."""
        full = []
        for r, (cells, _) in enumerate(self.rows):
            parts = [unpack_bits(answers[r, b], j - i) for b, (i, j) in enumerate(cuts(cells, self.buckets)) if j > i]
            full.append(np.concatenate(parts) if parts else np.empty(0, bool))
        out = []
        for b in self.blocks:
            ok = np.ones(len(b.key), bool)
            for r, (cells, _) in enumerate(self.rows):
                if len(b.key):
                    ok &= full[r][np.searchsorted(cells, _cells(b.key, r, self.bits))]
            out.append(np.flatnonzero(ok))
        return out

    def windows(self, estimated: list[np.ndarray]):
        """Distinct windows (hi, lo, twice or more here) in order, and of each estimated window its number among them."""
        both = [b.digests(b.start[w]) for b, w in zip(self.blocks, estimated)]
        hi = np.concatenate([x for x, _ in both]) if both else np.empty(0, np.uint64)
        lo = np.concatenate([x for _, x in both]) if both else np.empty(0, np.uint64)
        return distinct(hi, lo)


def distinct(hi: np.ndarray, lo: np.ndarray):
    order = np.lexsort((lo, hi))
    h, l = hi[order], lo[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (l[1:] != l[:-1])
    number = np.empty(len(h), np.int64)
    number[order] = np.cumsum(new) - 1
    return h[new], l[new], np.bincount(number, minlength=int(new.sum())), number


REQUEST = "bucket int, chunk int, row int, a binary, b binary, c binary"
ANSWER = "chunk int, bucket int, row int, bits binary"


def _table(schema: list[tuple[str, pa.DataType]], columns: list) -> pa.Table:
    return pa.table([pa.array(c, t) for (_, t), c in zip(schema, columns)], names=[n for n, _ in schema])


_REQUEST = [("bucket", pa.int32()), ("chunk", pa.int32()), ("row", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())]
_ANSWER = [("chunk", pa.int32()), ("bucket", pa.int32()), ("row", pa.int32()), ("bits", pa.binary())]


def _rows(names: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.Table:
    return _table(names, [list(c) for c in zip(*rows)] if rows else [[] for _ in names])


def _merge_counters(t: pa.Table) -> pa.Table:
    """One range of counters: adds what all chunks sent to an array of it, tells each chunk which of its counters reach 2."""
    out = []
    rows = t.select(["chunk", "bucket", "row"]).to_pylist()
    for row in sorted({r["row"] for r in rows}):
        own = [i for i, r in enumerate(rows) if r["row"] == row]
        cells = {i: unpack(t["a"][i].as_py()) for i in own}
        first = min(int(c[0]) for c in cells.values())
        counters = np.zeros(max(int(c[-1]) for c in cells.values()) + 1 - first, np.uint8)
        for i, c in cells.items():
            at = (c - np.uint64(first)).astype(np.int64)  # a chunk has a counter once
            counters[at] = np.minimum(counters[at] + 1 + unpack_bits(t["b"][i].as_py(), len(c)), 2)
        for i, c in cells.items():
            bits = counters[(c - np.uint64(first)).astype(np.int64)] > 1
            out.append((rows[i]["chunk"], rows[i]["bucket"], row, pack_bits(bits)))
    return _rows(_ANSWER, out)


def _merge_windows(t: pa.Table) -> pa.Table:
    """One bucket of windows: tells each chunk which of its windows start twice or more."""
    rows = t.to_pylist()
    hi = [unpack(r["a"]) for r in rows]
    many = np.concatenate([unpack_bits(r["b"], len(h)) for r, h in zip(rows, hi)])
    lo = np.concatenate([np.frombuffer(r["c"], np.uint64) for r in rows])
    _, _, counts, number = distinct(np.concatenate(hi), lo)
    reached = counts > 1
    reached[number[many]] = True
    bits, at, out = reached[number], 0, []
    for r, h in zip(rows, hi):
        out.append((r["chunk"], r["bucket"], DEPTH, pack_bits(bits[at : at + len(h)])))
        at += len(h)
    return _rows(_ANSWER, out)


def _answers(t: pa.Table, sketch: bool) -> dict[tuple[int, int], bytes]:
    return {(r["row"], r["bucket"]): r["bits"] for r in t.select(["row", "bucket", "bits"]).to_pylist() if (r["row"] < DEPTH) == sketch}


def repeats(docs: DataFrame, window: int = WINDOW, keep: bool = False, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, n_words, n_removed, kept_sha256, or with ``keep`` the kept text.

    With ``keep`` the result has the columns of ``docs`` with the kept words, joined by one space, in ``text``.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    width = width_bits(size)
    chunks = max(partitions(spark), parts_for(size, CHUNK_BYTES))
    # requests are under half the text: 16 bytes for a window estimated repeated, some bits for a counter
    buckets = max(parts_for(size // 2, BUCKET_BYTES), (1 << width) // RANGE)
    others = [F.col(c) for c in docs.columns if c != text]
    own = F.struct(*others) if keep and others else F.col(id_col)
    tasks = max(partitions(spark), size // TASK_BYTES)
    # which chunk a document is in is settled once: three stages have to agree on it, whatever is evaluated again
    dealt = stored(chunked(docs, {"row": own, "text": F.col(text)}, chunks, None, id_col), "dealt").repartition(tasks, "chunk")

    def ask(t: pa.Table) -> pa.Table:
        chunk = t["chunk"][0].as_py()
        return _rows(_REQUEST, [(b, chunk, r, cells, many, None) for b, r, cells, many in Chunk(t["text"], window, buckets, width).sketch()])

    def ask_again(t: pa.Table, answers: pa.Table) -> pa.Table:
        if not t.num_rows:
            return _rows(_REQUEST, [])
        c = Chunk(t["text"], window, buckets, width)
        hi, lo, counts, _ = c.windows(c.estimated(_answers(answers, True)))
        chunk = t["chunk"][0].as_py()
        rows = [(b, chunk, DEPTH, pack(hi[i:j]), pack_bits(counts[i:j] > 1), lo[i:j].tobytes()) for b, (i, j) in enumerate(cuts(hi, buckets)) if j > i]
        return _rows(_REQUEST, rows)

    def remove(t: pa.Table, answers: pa.Table) -> pa.Table:
        if not t.num_rows:
            return pa.table({"row": t["row"], "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.string())})
        c = Chunk(t["text"], window, buckets, width)
        estimated = c.estimated(_answers(answers, True))
        hi, _, _, number = c.windows(estimated)
        bits = _answers(answers, False)
        parts = [unpack_bits(bits[DEPTH, b], j - i) for b, (i, j) in enumerate(cuts(hi, buckets)) if j > i]
        repeated = np.concatenate(parts)[number] if parts else np.empty(0, bool)
        n_words, n_removed, kept, doc, seen = [], [], [], 0, 0
        for block, windows in zip(c.blocks, estimated):
            edge = np.zeros(len(block.wide) + 1, np.int64)
            starts = block.start[windows[repeated[seen : seen + len(windows)]]]
            seen += len(windows)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + window, -1)
            stays, at = np.cumsum(edge[:-1]) == 0, 0
            for n in block.lens.tolist():
                value = t["text"][doc].as_py()
                mask, doc = stays[at : at + n], doc + 1
                at += n
                words = words_of(value)
                left = words if mask.all() else [words[i] for i in np.flatnonzero(mask)]
                joined = b" ".join(left)
                n_words.append(n)
                n_removed.append(n - len(left))
                kept.append(joined.decode() if keep else hashlib.sha256(joined).hexdigest())
        return pa.table({"row": t["row"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.string())})

    asked = dealt.groupBy("chunk").applyInArrow(ask, REQUEST)
    cells = spread(asked, tasks, "bucket").groupBy("bucket").applyInArrow(_merge_counters, ANSWER)
    asked_again = dealt.groupBy("chunk").cogroup(cells.repartition(tasks, "chunk").groupBy("chunk")).applyInArrow(ask_again, REQUEST)
    found = spread(asked_again, tasks, "bucket").groupBy("bucket").applyInArrow(_merge_windows, ANSWER)
    both = cells.unionAll(found)
    # the row's own type, with what it says about nulls inside
    result = T.StructType([dealt.schema["row"], *[T.StructField(n, T.LongType()) for n in ("n_words", "n_removed")], T.StructField("kept", T.StringType())])
    out = dealt.groupBy("chunk").cogroup(both.repartition(tasks, "chunk").groupBy("chunk")).applyInArrow(remove, result)
    if not keep:
        return out.select(F.col("row").alias("id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256"))
    if not others:
        return out.select(F.col("kept").alias(text))
    whole = {c: F.col("row").getField(c) for c in docs.columns if c != text} | {text: F.col("kept")}
    return out.select(*[whole[c].alias(c) for c in docs.columns])


def op8_substring_dedup(docs: DataFrame) -> DataFrame:
    return repeats(docs).withColumnRenamed("id", "doc_id")
