"""A keyed table in versions: rows with a key replace those that have it, and readers see whole versions.

Rows are dealt into buckets by a hash of the key, each task writing a file for each of its buckets, so whole rows don't
move; only keys do, to tell which repeat. An upsert reads and rewrites only the buckets that its keys fall into, as a new generation of folders beside the old ones; then a version file says which generation holds each
bucket. That file is put in place last, by one rename, so a run that ends early leaves the version before
it, and readers under way keep theirs. ``vacuum`` deletes generations that no version kept needs.

The number of buckets is fixed when the table is made, so a version file has at most so many entries. Nothing of the
rows comes to the driver but the numbers of the buckets touched.

Defined results: of rows with one key in a batch, the last in ``order`` holds, without it the one whose hash is greatest. Null
is a key like any other. Columns that a batch or the table lacks are null. An empty batch changes nothing but makes the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..names import free_name

BUCKETS = 64


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, to: str) -> list[int]:
    """The versions there are, oldest first."""
    place, fs = _fs(spark, f"{to}/_versions")
    names = [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def _version(spark: SparkSession, to: str, number: int) -> dict:
    lines = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
    place, fs = _fs(spark, f"{to}/_versions/{number:010d}.json")
    stream = fs.open(place)
    try:
        return json.loads(lines.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _switch(spark: SparkSession, to: str, number: int, content: dict) -> None:
    """Put a version file in place: written beside it, then renamed. Fails if another writer was first."""
    draft, fs = _fs(spark, f"{to}/_versions/.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    final, _ = _fs(spark, f"{to}/_versions/{number:010d}.json")
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"version {number} of {to} was written by another run; run this one again")


def _rows(spark: SparkSession, to: str, told: dict, buckets: list[int] | None = None) -> DataFrame:
    schema = StructType.fromJson(told["schema"])
    places = [f"{to}/rows/{gen}/{told['column']}={b}" for b, gen in told["places"].items() if buckets is None or int(b) in buckets]
    return spark.read.schema(schema).parquet(*places) if places else spark.createDataFrame([], schema)


def _bucket(key: str, told: dict) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(told["buckets"])).cast("int")


def _numbers(rows: DataFrame, b: str) -> list[int]:
    """The buckets of ``rows``: at most as many as the table has."""
    return sorted(r[0] for r in rows.select(b).distinct().collect())


def _at(spark: SparkSession, schema: StructType, of: dict[int, str], b: str) -> DataFrame:
    """The rows of buckets in the folders that ``of`` tells."""
    return spark.read.schema(schema).parquet(*[f"{at}/{b}={i}" for i, at in of.items()])


def _write(rows: DataFrame, to: str, told: dict) -> None:
    """``rows`` by bucket, as they lie. A task keeps a small row group open for each bucket, so that it needn't sort whole rows by bucket."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    conf = rows.sparkSession.conf
    before = conf.get(setting, None)
    conf.set(setting, str(told["buckets"]))
    try:
        rows.write.partitionBy(told["column"]).options(**{"compression": "zstd", "parquet.block.size": str(16 << 20)}).parquet(to)
    finally:
        conf.unset(setting) if before is None else conf.set(setting, before)


def exists(spark: SparkSession, to: str) -> bool:
    return bool(versions(spark, to))


def read(spark: SparkSession, to: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default the last."""
    there = versions(spark, to)
    if not there or (version is not None and version not in there):
        raise ValueError(f"{to} has no version {'' if version is None else version}".rstrip())
    return _rows(spark, to, _version(spark, to, there[-1] if version is None else version))


def _one_each(rows: DataFrame, key: str, order: str | None) -> DataFrame:
    row = free_name(rows, "row")
    by = F.struct(F.col(order), F.xxhash64(F.to_json(F.struct("*")))) if order else F.xxhash64(F.to_json(F.struct("*")))
    one = rows.groupBy(F.col(key).alias(free_name(rows, "key"))).agg(F.max_by(F.struct("*"), by).alias(row))
    return one.select(f"{row}.*")


def upsert(rows: DataFrame, to: str, key: str, order: str | None = None, buckets: int = BUCKETS) -> int:
    """Add ``rows`` to the table ``to``, in place of those with the same ``key``; returns the new version.

    ``buckets`` counts when the table is made; later the table's own number holds.
    """
    spark = rows.sparkSession
    there = versions(spark, to)
    told = _version(spark, to, there[-1]) if there else {"places": {}, "buckets": buckets, "key": key, "column": free_name(rows, "bucket")}
    if told["key"] != key:
        raise ValueError(f"{to} is keyed by {told['key']}")
    b = told["column"]
    if b in rows.columns:
        raise ValueError(f"the table keeps its buckets under the name {b}")
    generation = uuid.uuid4().hex
    bucket = _bucket(key, told)
    # the batch is written once, by bucket; what the table has in these buckets and the batch hasn't joins it there
    staged, one, home = (f"{to}/rows/{generation}{part}" for part in ("-new", "-one", ""))
    _write(rows.withColumn(b, bucket), staged, told)
    kind = StructType([*rows.schema.fields]).add(b, "integer")
    new = spark.read.schema(kind).parquet(staged)
    touched = _numbers(new, b)
    of = {i: staged for i in touched}
    twice = _numbers(new.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").withColumn(b, bucket), b)
    if twice:
        _write(_one_each(_at(spark, rows.schema, {i: staged for i in twice}, b), key, order).withColumn(b, bucket), one, told)
        of |= {i: one for i in twice}
        new = _at(spark, rows.schema, of, b).withColumn(b, bucket)
    schema = rows.schema
    if there and touched:
        old = _rows(spark, to, told, touched).withColumn(b, bucket)
        k = free_name(old, "replaced", new)
        kept = old.join(new.select(F.col(key).alias(k)), F.col(key).eqNullSafe(F.col(k)), "left_anti")
        merged = kept.unionByName(new, allowMissingColumns=True)
        schema = merged.drop(b).schema
        _write(merged, home, told)
        of = {i: home for i in touched}
    elif there:
        schema = StructType.fromJson(told["schema"])
    places = told["places"] | {str(i): at.rsplit("/", 1)[1] for i, at in of.items()}
    number = (there[-1] if there else 0) + 1
    _switch(spark, to, number, {**told, "schema": json.loads(schema.json()), "places": places})
    for part in {staged, one} - set(of.values()):
        place, fs = _fs(spark, part)
        fs.delete(place, True)
    return number


def rewrite(spark: SparkSession, to: str, change: Callable[[DataFrame], DataFrame], changed: str) -> int:
    """Put ``change`` of the rows in their place, in the buckets where its column ``changed`` holds for any; returns the new version.

    ``change`` goes row by row and keeps keys and columns, but for ``changed``, which isn't stored. Each bucket is read and
    written where it is: nothing moves.
    """
    there = versions(spark, to)
    told = _version(spark, to, there[-1])
    b, home = told["column"], f"{to}/rows/{uuid.uuid4().hex}"
    rows = change(_rows(spark, to, told))
    touched = _numbers(rows.where(changed).select(_bucket(told["key"], told).alias(b)), b)
    schema = rows.drop(changed).schema
    for i in touched:
        change(_rows(spark, to, told, [i])).drop(changed).write.option("compression", "zstd").parquet(f"{home}/{b}={i}")
    places = told["places"] | {str(i): home.rsplit("/", 1)[1] for i in touched}
    _switch(spark, to, there[-1] + 1, {**told, "schema": json.loads(schema.json()), "places": places})
    return there[-1] + 1


def vacuum(spark: SparkSession, to: str, keep: int = 1) -> int:
    """Delete all but the last ``keep`` versions, and generations that none of these needs; returns how many. No upsert may be under way."""
    there = versions(spark, to)
    for number in there[:-keep]:
        place, fs = _fs(spark, f"{to}/_versions/{number:010d}.json")
        fs.delete(place, False)
    needed = {gen for n in there[-keep:] for gen in _version(spark, to, n)["places"].values()}
    place, fs = _fs(spark, f"{to}/rows")
    gone = 0
    for s in fs.listStatus(place) if fs.exists(place) else ():
        if s.getPath().getName() not in needed:
            fs.delete(s.getPath(), True)
            gone += 1
    return gone
