"""Sharding by extendible hashing: a directory over hash-prefix bits, split only where a bucket is too large.

A row's hash is the MD5 of its id and text digest; its first 60 bits are the hash bits. A bucket is
a prefix of ``depth`` bits. The directory starts with one bucket of depth 0; a bucket over the byte
limit splits on its next bit, and only such buckets do. The shard of a row is the shortest prefix of
its bits whose bucket fits the limit.

How it runs: each row's hash and size are stored once, numbered, so no later step reads a text. Rows are summed into cells of ``CELL_STEP`` bits, every cell gives its sum to each of
its prefixes, and the shortest fitting prefix of each cell is found by one aggregation. Rows in
cells that are still over the limit take the next ``CELL_STEP`` bits in another round. Rows of the
directory are never collected; the driver sees one number a round, how many cells stay open.

Defined results: a null text has 0 bytes, a null id hashes as the word null. Rows with equal id
and text can't be parted by hash bits: they share all 60 and go to numbered overflow pages of that
bucket (``page`` > 0), so many rows on each as fit; a single row over the limit is a shard of its
own with ``oversize`` true. An empty table gives no shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, stored

LIMIT = 8 << 20
BITS = 60
CELL_STEP = 12


def hash_bits(id_col: Column, text: Column) -> Column:
    """60 bits of MD5, as a long."""
    d = F.md5(F.concat_ws(":", F.coalesce(id_col.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(d, 1, 15), 16, 10).cast("long")


def _prefix(h: Column, depth: int) -> Column:
    return F.shiftright(h, BITS - depth)


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """(cell_depth, cell, depth, prefix, fits) for each cell of ``rows`` (h, bytes); a cell is in one bucket.

    ``depth`` is the bucket's. Where ``fits`` is false the bucket has one hash only and is over the limit.
    """
    done = None
    left, start = rows.select("h", "bytes"), 0
    while start < BITS:
        end = min(start + CELL_STEP, BITS)
        sums = [F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high")]
        cells = left.select(_prefix(F.col("h"), end).alias("cell"), "bytes", F.col("h").alias("low"), F.col("h").alias("high")).groupBy("cell").agg(*sums)
        steps = F.explode(F.sequence(F.lit(start if start == 0 else start + 1), F.lit(end))).alias("depth")
        ups = cells.select("*", steps).withColumn("prefix", F.expr(f"shiftright(cell, {end} - depth)"))
        # a bucket that holds one hash only can't be split: its rows go to pages
        done_at = ups.groupBy("depth", "prefix").agg(*sums).where((F.col("bytes") <= limit) | (F.col("low") == F.col("high")))
        fit = done_at.select("depth", "prefix", (F.col("bytes") <= limit).alias("fits"))
        found = ups.select("cell", "depth", "prefix").join(fit, ["depth", "prefix"]).groupBy("cell").agg(F.min(F.struct("depth", "prefix", "fits")).alias("f"))
        part = stored(cells.select("cell").join(found, "cell", "left").select(F.lit(end).alias("cell_depth"), "cell", "f.*"), "directory")
        closed = part.where("depth is not null")
        done = closed if done is None else done.unionByName(closed)
        open_cells = part.where("depth is null").select("cell")
        if end == BITS or open_cells.isEmpty():
            return done
        left = stored(left.withColumn("cell", _prefix(F.col("h"), end)).join(open_cells, "cell", "left_semi").drop("cell"), "open-rows")
        start = end
    raise AssertionError("unreachable")


def shards(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """One row for each row of ``docs``: id, bytes, depth, prefix, page, oversize, and with ``keep`` the row as a struct ``row``."""
    whole = F.struct("*") if keep else F.lit(None).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("bytes"), hash_bits(F.col(id_col), F.col(text)).alias("h"),
        F.monotonically_increasing_id().alias("_row"), whole.alias("row"),
    )
    rows = stored(rows, "hashed-rows")
    tree = directory(rows, limit)
    depths = sorted({r[0] for r in tree.select("cell_depth").distinct().collect()})  # at most BITS / CELL_STEP numbers
    parts = []
    for d in depths:
        cells = tree.where(F.col("cell_depth") == d).select("cell", "depth", "prefix", "fits")
        parts.append(rows.withColumn("cell", _prefix(F.col("h"), d)).join(cells, "cell"))
    out = parts[0] if parts else rows.join(tree.select("depth", "prefix", "fits"), F.lit(False))
    for p in parts[1:]:
        out = out.unionByName(p)
    # Rows that share all bits are alike: they are counted by the part of the input they came from, so that no task holds them all.
    at = out.withColumn("_part", F.shiftright("_row", 33))
    alike = at.where("not fits")
    counts = alike.groupBy("h", "_part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("h").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = counts.select("h", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("h", "_part").orderBy("_row")) - 1 + F.col("before")
    paged = alike.join(offset, ["h", "_part"]).withColumn("page", F.floor(nth / F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.col("bytes"), F.lit(1))))))
    one = at.where("fits").withColumn("page", F.lit(0).cast("long"))
    cols = ["id", "bytes", "depth", "prefix", F.col("page").cast("long").alias("page"), (F.col("bytes") > limit).alias("oversize"), *(["row"] if keep else [])]
    return one.select(*cols).unionByName(paged.select(*cols))


def write_shards(docs: DataFrame, to: str, limit: int = LIMIT, id_col: str = "doc_id", text: str = "text") -> None:
    """Write each shard of ``docs`` as the file of a folder ``shard=<name>`` under ``to``, with the columns of ``docs``."""
    name = free_name(docs, "shard")
    out = shards(docs, limit, id_col, text, keep=True)
    rows = out.select("row.*", shard_name(F.col("depth"), F.col("prefix"), F.col("page")).alias(name))
    rows.repartition(name).write.partitionBy(name).mode("overwrite").parquet(to)


def shard_name(depth: Column, prefix: Column, page: Column) -> Column:
    return F.concat(F.lit("d"), depth.cast("string"), F.lit("-"), prefix.cast("string"), F.lit("-"), page.cast("string"))


def op5_extendible_sharding(docs: DataFrame) -> DataFrame:
    out = shards(docs)
    return out.select(F.col("id").alias("doc_id"), "bytes", "depth", "prefix", "page", "oversize", shard_name(F.col("depth"), F.col("prefix"), F.col("page")).alias("shard"))
