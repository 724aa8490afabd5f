"""Target-distribution importance resampling over hashed n-grams, in DataFrame functions only.

Words of the raw documents and of the target texts make n-grams, and each falls into a bucket by its CRC-32. The
arrays of these, one for each document, are stored once, so texts are split once; they are exploded, and the buckets of
both corpora are counted (partial sums first, so a shuffle carries at most a row for each bucket and task). A
bucket's gain is the log of its smoothed share in the target over that in the raw corpus, in thousandths. The gain
table has one row for each bucket, which bounds its broadcast. It joins the arrays, exploded again, and gains
are summed by document, again in the task first. Scores are the floored mean gain plus Gumbel noise from a hash of the id, so
the highest scores are a sample without replacement in proportion to the weights, and reruns agree.

Ranks need no task that sees all rows: one distributed sort is stored with the partition and the place of each
row in it, the sizes of the partitions give offsets (one row for each sort task), and a rank is offset plus place. Rows
that agree in score and id are parted by a row number, so a frequent id doesn't fill one range.

Defined results: a null text has no words; a document without n-grams has weight 0. A null id hashes as the word null
and comes last among ties. Rows are handled each for itself, so rows with one id have ranks of their own. With no
target text all buckets count as unseen there. Other columns, whatever their names, change nothing.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, free_name, stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same with capitals, before they are lower-cased.
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BUCKETS, LONGEST, SEED = 10_000, 2, 7
#: The share drawn, in hundredths, of the documents with at least so many words.
DRAWN, FEWEST_WORDS = 25, 20


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased.

    ``lower`` does that for texts and words of ASCII only, and is much cheaper than ``translate``, which is left for others that have a capital.
    """
    t = F.coalesce(text, F.lit(""))
    ascii_only = lambda c: F.length(c) == F.octet_length(c)
    folded = lambda w: F.when(ascii_only(w), F.lower(w)).when(w.rlike("[A-Z]"), F.translate(w, string.ascii_uppercase, string.ascii_lowercase)).otherwise(w)
    plain = F.regexp_extract_all(F.lower(t), F.lit(WORD), F.lit(0))
    return F.when(ascii_only(t), plain).otherwise(F.transform(F.regexp_extract_all(t, F.lit(ANY_WORD), F.lit(0)), folded))


def grams(w: Column, longest: int = LONGEST) -> Column:
    """All runs of 1 to ``longest`` consecutive words, joined by a space."""
    runs = [w]
    for n in range(2, longest + 1):
        size = F.greatest(F.size(w) - (n - 1), F.lit(0))
        runs.append(F.zip_with(F.slice(runs[-1], F.lit(1), size), F.slice(w, F.lit(n), size), lambda a, b: F.concat(a, F.lit(" "), b)))
    return F.concat(*runs)


def featured(texts: DataFrame, id_col: str | None, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS, row: str | None = None) -> DataFrame:
    """(row, id, n_words, features), stored: the buckets of all n-grams of each text, repeats included."""
    named = texts.select((F.col(row) if row else F.monotonically_increasing_id()).alias("row"), (F.col(id_col) if id_col else F.lit(0)).alias("id"), words(F.col(text)).alias("w"))
    bucket = lambda g: (F.crc32(g.cast("binary")) % buckets).cast("int")
    return stored(named.select("row", "id", F.size("w").alias("n_words"), F.transform(grams(F.col("w"), longest), bucket).alias("features")), "features")


def bucket_counts(features: DataFrame) -> DataFrame:
    """(bucket, n): how many n-grams of all texts fall into each bucket that has any."""
    return features.select(F.explode("features").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of the buckets of ``raw``: both are results of ``bucket_counts``.

    The tables have at most ``buckets`` rows, so the totals are windows over them.
    """
    total = Window.partitionBy(F.lit(0))
    s = raw.select("bucket", F.col("n").alias("s"), F.sum("n").over(total).alias("all_s"))
    t = target.select(F.col("bucket").alias("b"), F.col("n").alias("t"))
    both = s.join(F.broadcast(t), F.col("bucket") == F.col("b"), "left").withColumn("t", F.coalesce("t", F.lit(0)))
    # all target n-grams, also those in buckets that raw hasn't
    sums = t.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("all_t"))
    both = both.join(F.broadcast(sums), F.lit(True))
    d = lambda c: F.col(c).cast("double")
    ratio = ((d("t") + 1) * (d("all_s") + float(buckets))) / ((d("s") + 1) * (d("all_t") + float(buckets)))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))


def _floored(a: Column, b: Column) -> Column:
    """a / b for longs, rounded down exactly."""
    return F.call_function("div", a - F.pmod(a, b), b)


def weighed(features: DataFrame, table: DataFrame) -> DataFrame:
    """(row, id, n_words, n_features, weight) for each row of ``featured``, by a gain table."""
    each = features.select("row", "id", "n_words", F.explode_outer("features").alias("bucket"))
    found = each.join(F.broadcast(table), "bucket", "left")
    sums = found.groupBy("row", "id", "n_words").agg(F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("sum"))
    return sums.select("row", "id", "n_words", "n_features", F.when(F.col("n_features") > 0, _floored(F.col("sum"), F.col("n_features"))).otherwise(F.lit(0)).cast("long").alias("weight"))


def noise(id_col: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from 32 bits of the SHA-256 of the seed and the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scored: DataFrame, drawn: int = DRAWN, fewest: int = FEWEST_WORDS) -> DataFrame:
    """``scored`` (row, id, n_words, score and others) with ``rank``: 1, 2, 3 by descending score, null beyond the draw."""
    scored = scored.withColumn("may", F.col("n_words") >= fewest)
    in_order = scored.orderBy(F.col("may").desc(), F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # within the partition
    rows = stored(in_order.select("*", F.spark_partition_id().alias("part"), place.alias("place")), "ranked")
    sizes = rows.where("may").groupBy("part").agg(F.count("*").alias("n"))  # a row for each sort task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.call_function("div", F.sum("n").over(whole) * drawn, F.lit(100)).alias("draw"))
    rank = F.col("before") + F.col("place") + 1
    out = rows.join(F.broadcast(offsets), "part", "left")
    return out.withColumn("rank", F.when(F.col("may") & (rank <= F.col("draw")), rank)).drop("part", "place", "before", "draw", "may")


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS, drawn: int = DRAWN, fewest: int = FEWEST_WORDS, seed: int = SEED, row: str | None = None) -> DataFrame:
    """One row for each row of ``docs``: row, id, n_words, n_features, weight, score, rank."""
    own, other = featured(docs, id_col, text, longest, buckets, row), featured(target, None, target_text, longest, buckets)
    table = stored(gains(bucket_counts(own), bucket_counts(other), buckets), "gains")
    out = ranked(weighed(own, table).withColumn("score", F.col("weight") + noise(F.col("id"), seed)), drawn, fewest)
    for t in (own, other, table):
        dropped(t)
    return out


def sample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The documents drawn: the rows of ``docs`` that have a rank, with their columns and the rank, named last."""
    row = free_name(docs, "row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")  # two readers see the same numbers
    drawn = resampled(numbered, target, row=row, **options).where("rank is not null")
    drawn = drawn.select(F.col("row").alias(row), F.col("rank").alias(free_name(numbered, "rank")))
    return numbered.join(drawn, row).drop(row)


def op11_importance_resampling(docs: DataFrame, target: DataFrame) -> DataFrame:
    out = resampled(docs, target)
    return out.select(F.col("id").alias("doc_id"), F.col("n_features").cast("long"), "weight", "score", F.col("rank").cast("long"))
