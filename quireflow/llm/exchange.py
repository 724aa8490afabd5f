"""Chunks that ask keyed tables: packed requests and answers in place of a row for each occurrence.

Documents are dealt into chunks by a hash, with the input partition as salt, so that equal rows
spread. The number of chunks and of buckets follows the size of the input: each holds about a documented number of
bytes, so a task's memory doesn't grow with the corpus. A chunk sends each of its distinct keys once to the key's bucket, as sorted packed arrays;
the bucket answers with packed values in the order asked. So a key that half the corpus uses is one
entry for each chunk, and no task holds the occurrences of a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, words_of

#: Words in a block of documents that is handled at once; a longer document is a block of its own.
BLOCK_WORDS = 200_000


def chunked(docs: DataFrame, columns: dict[str, Column], chunks: int, tasks: int | None, id_col: str = "doc_id") -> DataFrame:
    """``columns`` of ``docs`` and ``chunk``, dealt by chunk to so many tasks, if told; exchanged once for all who read it."""
    chunk = F.pmod(F.xxhash64(F.col(id_col), F.spark_partition_id()), F.lit(chunks)).cast("int")
    out = docs.select(chunk.alias("chunk"), *[c.alias(k) for k, c in columns.items()])
    return out if tasks is None else out.repartition(tasks, "chunk")


#: The fewest parts, so that a small input has some work for many tasks.
FEWEST_PARTS = 64


def parts_for(total: int, each: int) -> int:
    """How many parts of about ``each`` bytes ``total`` bytes make."""
    return max(FEWEST_PARTS, -(-total // each))


def spread(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks, if that is more than the session's shuffle partitions."""
    return df.repartition(tasks, *keys) if tasks > partitions(df.sparkSession) else df


def pack(a: np.ndarray) -> bytes:
    """Sorted uint64 values: the first, and differences of as many bytes as the largest needs."""
    if not len(a):
        return b""
    d = np.diff(a)
    width = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    return bytes([width]) + int(a[0]).to_bytes(8, "little") + np.ascontiguousarray(d).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(b: bytes) -> np.ndarray:
    if not b:
        return np.empty(0, np.uint64)
    width, n = b[0], (len(b) - 9) // b[0]
    raw = np.zeros((n + 1, 8), np.uint8)
    raw[0] = np.frombuffer(b, np.uint8, 8, 1)
    raw[1:, :width] = np.frombuffer(b, np.uint8, offset=9).reshape(-1, width)
    return np.cumsum(raw.view(np.uint64).ravel(), dtype=np.uint64)


def pack_ints(a: np.ndarray) -> bytes:
    """Numbers that aren't negative, as many bytes each as the largest needs."""
    if not len(a):
        return b""
    width = max(1, (int(a.max()).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(a, dtype=np.int64).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_ints(b: bytes) -> np.ndarray:
    if not b:
        return np.empty(0, np.int64)
    raw = np.zeros(((len(b) - 1) // b[0], 8), np.uint8)
    raw[:, : b[0]] = np.frombuffer(b, np.uint8, offset=1).reshape(-1, b[0])
    return raw.view(np.int64).ravel()


def pack_few(a: np.ndarray) -> bytes:
    """Numbers that are mostly 0 or 1: two bits each, and the larger ones apart."""
    return pack_bits(a > 0) + pack_bits(a > 1) + pack_ints(a[a > 1])


def unpack_few(b: bytes, n: int) -> np.ndarray:
    plane = (n + 7) // 8
    out = unpack_bits(b[:plane], n).astype(np.int64)
    out[unpack_bits(b[plane : 2 * plane], n)] = unpack_ints(b[2 * plane :])
    return out


def pack_ranks(a: np.ndarray) -> bytes:
    """Numbers under 2^28, small ones most often: seven bits to a byte, the top bit set where one more follows."""
    a = a.astype(np.int64)
    size = 1 + (a >= 1 << 7) + (a >= 1 << 14) + (a >= 1 << 21)
    end = np.cumsum(size)
    out = np.zeros(int(end[-1]) if len(a) else 0, np.uint8)
    for k in range(4):
        has = size > k
        out[(end - size)[has] + k] = (a[has] >> 7 * k & 127) | np.where(size[has] > k + 1, 128, 0)
    return out.tobytes()


def unpack_ranks(b: bytes) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8)
    last = raw < 128
    first = np.concatenate([np.zeros(1, np.int64), np.flatnonzero(last)[:-1] + 1]) if len(raw) else np.empty(0, np.int64)
    if not len(first):
        return first
    at = np.arange(len(raw)) - np.repeat(first, np.diff(np.append(first, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.int64) << 7 * at, first)


def pack_bits(a: np.ndarray) -> bytes:
    return np.packbits(a).tobytes()


def unpack_bits(b: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)


def bounds(buckets: int) -> np.ndarray:
    """The least uint64 key of each bucket: equal ranges, in order."""
    return np.array([(i << 64) // buckets for i in range(buckets)], dtype=np.uint64)


def cuts(keys: np.ndarray, buckets: int) -> list[tuple[int, int]]:
    """(start, end) in the sorted ``keys`` of each bucket's share."""
    at = [*np.searchsorted(keys, bounds(buckets)).tolist(), len(keys)]
    return list(zip(at, at[1:]))


def mixed(a: np.ndarray, salt: int) -> np.ndarray:
    """A bijection of uint64 that scatters (the finaliser of splitmix64)."""
    z = a + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def hashes(words: list[bytes]) -> np.ndarray:
    """64 bits for each word."""
    digest = xxhash.xxh3_64_digest
    return np.frombuffer(b"".join([digest(w) for w in words]), dtype=np.uint64)


def wide_hashes(words: list[bytes]) -> np.ndarray:
    """128 bits for each word, as two columns."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(w) for w in words]), dtype=np.uint64).reshape(-1, 2)


def blocks(texts: pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words in each document, wide hashes of all of them) for runs of documents in order."""
    lens: list[int] = []
    parts: list[np.ndarray] = []
    total = 0
    for t in texts:
        h = wide_hashes(words_of(t.as_py()))
        lens.append(len(h))
        parts.append(h)
        total += len(h)
        if total >= BLOCK_WORDS:
            yield np.array(lens, np.int64), np.concatenate(parts)
            lens, parts, total = [], [], 0
    if lens:
        yield np.array(lens, np.int64), np.concatenate(parts)
