"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is ``-ln(u) / weight`` with ``u`` from a hash of its id, its text and the seed, so reruns
agree; the smallest keys come first. The weight is the document's quality: ``2 ** -k`` for a document that
fails k rules of the quality ledger (``quality.RULES``), so each failure halves it; another expression can
be given. A source's target is met by whole epochs first (every document once more each), then by
documents in key order while the running sum of sizes stays within the rest; the document that crosses it is
taken if that brings the sum nearer.

Each document is measured once and what the rest needs is stored. The running sum doesn't need a source in
one task: rows are dealt by ranges of (source, key, id, row) whose bounds Spark samples from the keys themselves, so
ranges have about ``RANGE_ROWS`` rows each whatever the weights are; sizes are summed by (source, range), and only these sums are
accumulated in order; within a range a window orders the documents. The sources' targets are found by
windows over one row for each source, with nothing collected to the driver.

Defined results: a null or empty text has size 0 and is never taken. A null source is a source of
its own, last in order. Rows with one id and different texts have keys of their own; rows that agree in id and text are
interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import quality
from .common import free_name, partitions, stored, u_from

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_EPOCHS = 2.0
SEED = 20
#: Rows that a range of keys should hold.
RANGE_ROWS = 50_000


def quality_weight(bits: Column) -> Column:
    """The default document weight: halved for each rule that the document fails."""
    return F.pow(F.lit(0.5), F.bit_count(bits))


def targets(sizes: DataFrame, share: float = SHARE, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """source, n, target for the rows (source, n) of ``sizes``: sources in code point order, null last, take the weights in turn.

    A target above ``most`` times its source's size is cut to that and the excess shared anew by
    weight among the others, until none is above. The sources cut are those with the least size for
    their weight: in that order, the first at which the rest's share fits gives the level for it and all after it.
    """
    placed = sizes.withColumn("i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("i") - 1) % len(weights) + 1).cast("int"))
    rows = placed.withColumn("w", w).withColumn("cap", F.lit(most) * F.col("n")).withColumn("ratio", F.col("cap") / F.col("w"))
    order = Window.orderBy("ratio", "i")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cut = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_ = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("share", (F.lit(share) * F.sum("n").over(whole) - cut) / open_)
    level = F.first(F.when(F.col("share") <= F.col("ratio"), F.col("share")), True).over(whole)
    rows = rows.withColumn("level", level)
    return rows.select("source", "n", F.when(F.col("level") <= F.col("ratio"), F.least("cap", F.col("level") * F.col("w"))).otherwise(F.col("cap")).alias("target"))


def _measured(docs: DataFrame, seed: int, weight: Column | None, keep: bool, lang: str | None) -> DataFrame:
    """_id, _src, _size, _key, _row of each row, stored: the texts are read once."""
    own = F.struct("*") if keep else F.lit(None).cast("string")
    m = docs.select(F.col("doc_id").alias("_id"), F.col("source").cast("string").alias("_src"), F.md5(F.coalesce("text", F.lit(""))).alias("_tie"), quality._measures(docs, "text", lang).alias("_m"), own.alias("_row"))
    m = m.withColumn("_size", F.col("_m.n_words")).withColumn("_bits", quality._bits("_m"))
    w = quality_weight(F.col("_bits")) if weight is None else weight
    u = u_from(F.concat(F.coalesce(F.col("_id").cast("string"), F.lit("null")), F.lit(":"), F.col("_tie")), seed)
    return stored(m.select("_id", "_src", "_size", (-F.log(u) / w).alias("_key"), F.monotonically_increasing_id().alias("_n"), "_row"), "mix")


def ranged(base: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(_n, _id, _src, _size, _key, _range), stored: rows in order of source and key, in ranges of about ``range_rows``."""
    ranges = max(partitions(base.sparkSession), -(-base.count() // range_rows))
    order = [F.col("_src").asc_nulls_last(), F.col("_key").asc(), F.col("_id").asc_nulls_last(), F.col("_n").asc()]
    rows = base.select("_n", "_id", "_src", "_size", "_key").repartitionByRange(ranges, *order)
    return stored(rows.withColumn("_range", F.spark_partition_id()), "mix-ranges")


def mix(docs: DataFrame, seed: int = SEED, weight: Column | None = None, keep: bool = False, lang: str | None = "lang", range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row for each row of ``docs``: id, source, size, source_size, target, taken, copies.

    ``copies`` says how often the mix holds the document; ``taken`` is ``copies * size``. With
    ``keep`` the columns of ``docs`` come along and only a column of copies, named last, is added.
    ``weight`` is an expression over the columns ``_size`` and ``_bits`` (failed rules).
    """
    base = _measured(docs, seed, weight, keep, lang)
    sizes = base.groupBy("_src").agg(F.sum("_size").alias("n")).withColumnRenamed("_src", "source")
    plan = targets(sizes).select(F.col("source").alias("_s"), F.col("n").alias("_source_size"), F.col("target").alias("_target"))
    epochs = F.when(F.col("_source_size") > 0, F.least(F.floor(F.col("_target") / F.col("_source_size")), F.lit(int(MOST_EPOCHS)))).otherwise(0)
    plan = plan.withColumn("_epochs", epochs.cast("int"))
    keyed = ranged(base, range_rows)
    sums = keyed.groupBy("_src", "_range").agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy("_src").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("_src"), F.col("_range").alias("_r"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    offsets = offsets.join(plan, offsets["_src"].eqNullSafe(plan["_s"])).select("_s", "_r", "_before", "_source_size", "_target", "_epochs")
    joined = keyed.join(offsets, F.col("_src").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    within = Window.partitionBy("_src", "_range").orderBy("_key", F.col("_id").asc_nulls_last(), "_n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("_before") + F.sum("_size").over(within)
    rest = F.col("_target") - F.col("_epochs") * F.col("_source_size")
    partly = (end - F.col("_size") / 2.0 <= rest) & (F.col("_epochs") < MOST_EPOCHS)
    out = joined.withColumn("_copies", F.when(F.col("_size") == 0, 0).otherwise(F.col("_epochs") + partly.cast("int")))
    if keep:  # the rows themselves join what was found for their numbers
        return base.select("_n", "_row").join(out.select("_n", "_copies"), "_n").select("_row.*", F.col("_copies").alias(free_name(docs, "copies")))
    return out.select(
        F.col("_id").alias("id"), F.col("_src").alias("source"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"), F.col("_copies").alias("copies"),
    )


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, with their columns."""
    out = mix(docs, seed, keep=True)
    copies = out.columns[-1]
    return out.withColumn(copies, F.explode(F.array_repeat(F.lit(1), F.col(copies)))).drop(copies)


def op10_source_mixing(docs: DataFrame) -> DataFrame:
    return mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")
