"""Helpers that several operators share: words, shared storage, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..names import free_name  # noqa: F401
from ..session import shared_dir

#: Rows in an Arrow batch that a Python operator gets; texts can be long, so few.
BATCH_ROWS = 1000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def words_of(text: str | None) -> list[bytes]:
    """The maximal runs of characters other than space and U+0009 to U+000D, as UTF-8.

    ``bytes.split`` parts at exactly these six bytes, and UTF-8 never has them inside a longer
    character. Null is an empty text.
    """
    return text.encode("utf-8", "surrogatepass").split() if text else []


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: the lineage ends there.

    The files survive lost executors. They go when the application ends, or before by ``dropped``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")  # this write's shuffle files go with its end: nothing else reads them
    try:
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    gone_at_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_in = path
    return out


def gone_at_exit(spark: SparkSession, path: str) -> None:
    """A folder that is there goes when the application ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def dropped(table: DataFrame) -> None:
    """Delete the files of a ``stored`` table that no result needs any more."""
    spark = table.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(table._stored_in)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def map_arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` over batches of bounded size: long batches are sliced before ``f`` sees them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(b.slice(i, BATCH_ROWS) for b in batches for i in range(0, b.num_rows, BATCH_ROWS))

    return df.mapInArrow(run, schema)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the box keeps a public vocabulary; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def u_from(col, seed: int):
    """A number in (0, 1) from 60 bits of the MD5 of the value's text and ``seed``: the same in every run and engine."""
    digest = F.md5(F.concat(F.coalesce(col.cast("string"), F.lit("null")), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def put_file(spark: SparkSession, name: str, content: bytes) -> str:
    """Write a file into the shared folder, whatever store that is; returns its URI. It goes when the application ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    fs.deleteOnExit(path)
    return fs.makeQualified(path).toString()
