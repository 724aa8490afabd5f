"""An inverted index of a verse corpus, kept on disk, and quotations located through it.

The letters of all verses make one stream. ``grams`` has a row for each place of it: six letters and the place, in
a table bucketed by the letters, so a probe moves only the quotations' grams, never the index. ``counts`` says
how often each gram comes, bucketed alike. ``cells`` has the letters themselves, cut into cells of ``CELL``, and ``spans``
which verse has which letters of a cell; both are met only by the few places that a probe finds.

An anchor is looked up by the rarest of up to ``PROBES`` of its grams, evenly spaced: a gram that half the verses share
is chosen only where the others are no rarer. An anchor with a gram that the corpus lacks can't stand in it and goes at once.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import arrow as A
from ..functions import text as T
from ..sources.files import exists

GRAM, CELL = 6, 256
#: Verses that are numbered together, and files of each bucketed table.
BLOCK, BUCKETS = 4096, 16
#: Grams of an anchor whose frequencies are looked up: a quotation of n words has some n * n / 2 anchors.
PROBES = 8
#: Verses from the first on that an anchor may reach over.
REACH = 12


@dataclass(frozen=True)
class VerseIndex:
    grams: DataFrame
    counts: DataFrame
    cells: DataFrame
    spans: DataFrame


def _pieces(verses: DataFrame) -> DataFrame:
    """idx, cell, low, high, piece: the letters of each verse that fall into each cell, by places in the whole stream."""
    own = verses.select("idx", F.coalesce(T.skeleton(A.nfkc(F.col("niqqud"))), F.lit("")).alias("own"), F.floor(F.col("idx") / BLOCK).alias("block"))
    sums = own.groupBy("block").agg(F.sum(F.length("own")).alias("n"))  # a row for each block of verses
    up_to = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("block", F.coalesce(F.sum("n").over(up_to().orderBy("block")), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum(F.length("own")).over(up_to("block").orderBy("idx")), F.lit(0))
    placed = own.withColumn("inside", inside).join(before, "block").withColumn("low", F.col("before") + F.col("inside")).where("own <> ''")
    last = F.col("low") + F.length("own") - 1
    each = placed.select("idx", "own", "low", last.alias("last"), F.explode(F.sequence(F.floor(F.col("low") / CELL), F.floor(last / CELL))).alias("cell"))
    low, high = F.greatest("low", F.col("cell") * CELL), F.least(F.col("last"), F.col("cell") * CELL + CELL - 1)
    piece = F.substring(F.col("own"), (low - F.col("low") + 1).cast("int"), (high - low + 1).cast("int"))
    return each.select("idx", "cell", low.alias("low"), high.alias("high"), piece.alias("piece"))


def _bucketed(df: DataFrame, to: str, name: str) -> None:
    table = _table(to, name)
    df.sparkSession.sql(f"drop table if exists {table}")
    df.repartition(BUCKETS, "gram").write.bucketBy(BUCKETS, "gram").sortBy("gram").option("path", f"{to}/{name}").mode("overwrite").saveAsTable(table)


def _table(to: str, name: str) -> str:
    return f"verse_{name}_{hashlib.md5(to.encode()).hexdigest()}"


def kept_index(verses: DataFrame, to: str) -> VerseIndex:
    """The index of ``verses`` (idx, niqqud), kept in ``to``: made if it isn't there, else only read, in any session."""
    spark = verses.sparkSession
    if not exists(spark, f"{to}/done"):
        _pieces(verses).write.mode("overwrite").parquet(f"{to}/spans")
        parts = F.array_sort(F.collect_list(F.struct("low", "piece")))
        cells = spark.read.parquet(f"{to}/spans").groupBy("cell").agg(F.array_join(F.transform(parts, lambda x: x["piece"]), "").alias("letters"))
        cells.write.mode("overwrite").parquet(f"{to}/cells")
        cells = spark.read.parquet(f"{to}/cells")
        after = cells.select((F.col("cell") - 1).alias("cell"), F.substring("letters", 1, GRAM - 1).alias("after"))
        wide = cells.join(after, "cell", "left").withColumn("letters", F.concat("letters", F.coalesce("after", F.lit(""))))
        starts = F.sequence(F.lit(1), F.greatest(F.length("letters") - GRAM + 1, F.lit(1)))
        each = wide.where(F.length("letters") >= GRAM).select("cell", "letters", F.explode(starts).alias("i"))
        grams = each.select(F.expr(f"substring(letters, i, {GRAM})").alias("gram"), (F.col("cell") * CELL + F.col("i") - 1).alias("at"))
        _bucketed(grams, to, "grams")
        _bucketed(spark.table(_table(to, "grams")).groupBy("gram").agg(F.count("*").alias("n")), to, "counts")
        spark.range(1).write.mode("overwrite").parquet(f"{to}/done")
    return opened_index(spark, to)


def opened_index(spark: SparkSession, to: str) -> VerseIndex:
    """An index that ``kept_index`` made, in this session or another."""
    for name, columns in (("grams", "gram string, at bigint"), ("counts", "gram string, n bigint")):
        spark.sql(f"create table if not exists {_table(to, name)} ({columns}) using parquet clustered by (gram) sorted by (gram) into {BUCKETS} buckets location '{to}/{name}'")
    return VerseIndex(spark.table(_table(to, "grams")), spark.table(_table(to, "counts")), spark.read.parquet(f"{to}/cells"), spark.read.parquet(f"{to}/spans"))


def places(anchors: DataFrame, index: VerseIndex, keys: list[str]) -> DataFrame:
    """keys, first, last, at: every place in the corpus where an ``anchor`` (six letters or more) stands.

    ``first`` and ``last`` are the verses of its first and last letter, at most ``REACH`` verses in all.
    """
    a = anchors.select(F.struct(*keys).alias("k"), "anchor").where(F.length("anchor") >= GRAM)
    last = F.length("anchor") - GRAM  # of its grams, from 0
    spaced = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda i: (F.floor(i * last / (PROBES - 1)) + 1).cast("int")))
    each = a.select("k", "anchor", F.size(spaced).alias("asked"), F.explode(spaced).alias("i")).withColumn("gram", F.expr(f"substring(anchor, i, {GRAM})"))
    rare = each.join(index.counts, "gram").groupBy("k", "anchor", "asked").agg(F.min_by(F.struct("gram", "i"), F.struct("n", "i")).alias("rare"), F.count("*").alias("there"))
    rare = rare.where(F.col("there") == F.col("asked")).select("k", "anchor", "rare.*")
    met = rare.join(index.grams, "gram").select("k", "anchor", (F.col("at") - F.col("i") + 1).alias("at")).where("at >= 0").withColumn("to", F.col("at") + F.length("anchor") - 1)
    # letters join for these places only
    cell = lambda c: F.floor(F.col(c) / CELL)
    wide = met.withColumn("cell", F.explode(F.sequence(cell("at"), cell("to")))).join(index.cells, "cell")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cell", "letters"))), lambda x: x["letters"]), "")
    there = wide.groupBy("k", "anchor", "at", "to").agg(text.alias("letters"))
    there = there.where(F.expr(f"substring(letters, cast(at % {CELL} as int) + 1, length(anchor))") == F.col("anchor")).drop("letters")

    def verse(c: str, out: str, rows: DataFrame) -> DataFrame:
        s = index.spans.select(F.col("idx").alias(out), "cell", "low", "high")
        return rows.withColumn("cell", cell(c)).join(s, "cell").where(F.col(c).between(F.col("low"), F.col("high"))).drop("cell", "low", "high")

    out = verse("to", "last", verse("at", "first", there))
    return out.where(F.col("last") - F.col("first") < REACH).select("k.*", "first", "last", "at")
