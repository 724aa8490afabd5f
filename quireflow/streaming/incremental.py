"""Incremental processing: files that came since the last run, and keys that no run has had."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..names import free_name


def new_keys(stream: DataFrame, key: str, event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """The rows of a stream whose ``key`` hasn't come before, told by keyed state; null is no key, so such rows all stay.

    With ``event_time`` and ``delay`` a key is remembered until the watermark is ``delay`` beyond its row, so
    the state is bounded; a row at or under the watermark is late and left out, as its key may be forgotten. Without them
    every key is remembered (the keys alone, spread over the state's partitions). Of rows with one key in a batch one is taken.
    """
    named, unnamed = stream.where(F.col(key).isNotNull()), stream.where(F.col(key).isNull())
    if event_time is None:
        return named.dropDuplicates([key]).unionByName(unnamed)
    at = free_name(stream, "at")
    marked = named.withColumn(at, F.col(event_time).cast("timestamp")).withWatermark(at, delay)
    return marked.dropDuplicatesWithinWatermark([key]).drop(at).unionByName(unnamed)


def process_new(
    spark: SparkSession,
    source: str,
    schema: StructType,
    to: str,
    checkpoint: str,
    key: str,
    step: Callable[[DataFrame], DataFrame],
    pattern: str = "*.parquet",
    force: bool = False,
    event_time: str | None = None,
    delay: str | None = None,
) -> None:
    """Run ``step`` over what is new under ``source`` and add its rows to ``to``, then stop.

    The checkpoint remembers files, and in its state keys (``new_keys``); the output is never read, so a batch costs what is new in it.
    With ``force`` keys don't count and all rows of new files are taken. Each batch has its own folder ``batch=N`` under
    ``to`` and replaces it, so a batch that is run again after a failure leaves its rows once.
    """
    stream = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(source)
    rows = stream if force else new_keys(stream, key, event_time, delay)

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{to}/batch={number}")

    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
