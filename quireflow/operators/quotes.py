"""Quotations: found in a verse corpus by their letters, and made clean from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrow as A
from ..functions import constants as C
from ..functions import text as T
from ..names import free_name
from ..session import scratch
from .verse_index import VerseIndex, kept_index, places

#: Steps between first and last verse of a match that is trusted.
SPAN = 3


def located(quotes: DataFrame, verses: DataFrame, quote_id: str = "quote_id", quote: str = "quote", index: VerseIndex | None = None) -> DataFrame:
    """quote_id, first, last: the verses of the best anchor's first place in the corpus.

    Anchors (``arrow.anchors``) are tried in their order; ``verse_index.places`` finds them. A best anchor over
    more than ``SPAN`` steps is not trusted, and no other is tried in its place. Without an ``index`` one is made for this call.
    """
    index = index or kept_index(verses, scratch(verses.sparkSession, "verse-index"))
    a = quotes.select(F.col(quote_id).alias("id"), F.posexplode(A.quote_anchors(F.col(quote))).alias("rank", "anchor"))

    def best(anchors: DataFrame) -> DataFrame:
        first = F.min_by(F.struct("first", "last"), F.struct("rank", "at"))
        return places(anchors, index, ["id", "rank"]).groupBy("id").agg(first.alias("b"))

    whole = best(a.where("rank = 0"))  # where that stands, no other anchor of the many counts
    rest = best(a.where("rank > 0").join(whole.select("id"), "id", "left_anti"))
    out = whole.unionByName(rest).select(F.col("id").alias(quote_id), "b.*")
    return out.where(F.col("last") - F.col("first") <= SPAN)


def resolved(quotes: DataFrame, verses: DataFrame, quote_id: str = "quote_id", quote: str = "quote", index: VerseIndex | None = None) -> DataFrame:
    """quote_id, text, book, chapter, verse: the clean verses of a quotation with one more on either side in the same book."""
    found = located(quotes, verses, quote_id, quote, index)
    head = verses.select(F.col("idx").alias("first"), "book", "chapter", "verse")
    wide = found.join(head, "first").withColumn("at", F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)))
    near = verses.select(F.col("idx").alias("at"), F.col("book").alias("_book"), "niqqud")
    inside = F.col("at").between(F.col("first"), F.col("last")) | (F.col("_book") == F.col("book"))
    parts = F.array_sort(F.collect_list(F.struct("at", "niqqud")))
    j = wide.join(near, "at").where(inside).groupBy(quote_id, "book", "chapter", "verse").agg(parts.alias("p"))
    return j.select(quote_id, F.array_join(F.transform("p", lambda x: x["niqqud"]), " ").alias("text"), "book", "chapter", "verse")


def verse_texts(refs: DataFrame, verses: DataFrame) -> DataFrame:
    """id, text: the verses of each id's references (id, pos, book, chapter, verse), joined; null if any isn't there.

    A reference without a verse is the whole chapter; chapters and verses of references are letters.
    """
    ends = F.transform(F.split(F.coalesce("verse", F.lit("")), "[-\\u05BE]"), lambda p: T.letter_sum(p))
    low, high = F.col("ends")[0], F.coalesce(F.nullif(F.get(F.col("ends"), F.lit(1)), F.lit(0)), F.col("ends")[0])
    r = refs.withColumn("ends", ends).select("id", "pos", F.col("book").alias("_b"), T.letter_sum(F.col("chapter")).alias("_c"), low.alias("low"), high.alias("high"))
    on = (F.col("_b") == F.col("book")) & (F.col("_c") == F.col("chapter")) & ((F.col("low") == 0) | F.col("verse").between(F.col("low"), F.col("high")))
    j = r.join(verses.where("niqqud <> ''"), on, "left").groupBy("id", "pos").agg(F.array_sort(F.collect_list(F.when(F.col("idx").isNotNull(), F.struct("idx", "niqqud")))).alias("p"))
    text = F.when(F.size("p") > 0, F.array_join(F.transform("p", lambda x: x["niqqud"]), " "))
    each = j.select("id", "pos", text.alias("t")).groupBy("id").agg(F.count_if(F.col("t").isNull()).alias("missing"), F.array_sort(F.collect_list(F.struct("pos", "t"))).alias("ts"))
    return each.select("id", F.when(F.col("missing") == 0, F.array_join(F.transform("ts", lambda x: x["t"]), " ")).alias("text"))


def vocalized_quote(text: Column) -> Column:
    """The longest text in quotation marks that has a mark or a lost character."""
    spans = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit('"([^"]+)"'), 1), lambda s, i: F.struct(F.length(s).alias("n"), (-i).alias("i"), s.alias("text")))
    return F.array_max(F.filter(spans, lambda s: T.is_vocalized(s["text"])))["text"]


ELLIPSIS = r"(?U)\s*(?:…|\.\s*\.\s*\.+|\.{2,})\s*"
#: Letters under which a part of a quotation isn't looked for, and words that its place may have beyond those quoted.
LEAST_LETTERS, SLACK = 4, 2
#: Stands between the parts while they are normalised together.
BETWEEN = "\x01"


def with_alignment(rows: DataFrame, quote: str = "quote", source: str = "text", out: str = "aligned") -> DataFrame:
    """``rows`` with a last column ``out`` (or a longer name that is free): the words of the clean ``source`` that ``quote`` has, its gaps kept.

    The source is an array of words with the number of letters up to each word's end. The parts of the
    quotation between ellipses become streams of letters, their places in the source's letters are found
    together (``arrow.places``), and what a place takes in is read off the ends: first and last word. Null if a part
    isn't found or takes in over ``SLACK`` words more than were quoted, or if no part has ``LEAST_LETTERS``. A
    short form of the Name in the quotation stays one.
    """
    words = lambda c: F.filter(F.split(T.trim(c), T.GAP), lambda w: w != "")
    step = rows.select(F.struct("*").alias("_row"), words(F.col(source)).alias("_words"), F.split(F.col(quote), ELLIPSIS).alias("_raw"))
    step = step.withColumn("_letters", A.letter_lists(F.col("_words"))).withColumn("_plain", F.split(A.nfkc(F.array_join("_raw", BETWEEN)), BETWEEN))

    def part(raw: Column, plain: Column) -> Column:
        n = F.size(F.filter(words(raw), lambda w: w.rlike(f"[{C.LETTERS}]")))
        named = F.exists(words(plain), lambda w: T.bare_name(w).isin(C.NAME_SHORT))
        return F.struct(T.quote_stream(plain).alias("needle"), n.alias("n"), named.alias("named"))

    parts = F.filter(F.zip_with("_raw", "_plain", part), lambda p: F.length(p["needle"]) >= LEAST_LETTERS)
    step = step.withColumn("_ends", A.letter_ends(F.col("_letters"))).withColumn("_parts", parts)
    step = step.withColumn("_places", A.quote_places(F.transform("_parts", lambda p: p["needle"]), F.array_join("_letters", "")))

    def word_at(letter: Column) -> Column:
        return F.size(F.filter("_ends", lambda e: e <= letter))

    found = F.zip_with("_parts", "_places", lambda p, x: F.struct(p["n"].alias("n"), p["named"].alias("named"), word_at(x["start"]).alias("first"), word_at(x["start"] + x["length"] - 1).alias("last"), x.isNotNull().alias("there")))
    fits = F.forall(found, lambda f: f["there"] & (f["last"] - f["first"] + 1 <= f["n"] + SLACK)) & (F.size(found) > 0)

    def told(f: Column) -> Column:
        span = lambda a: F.slice(a, f["first"] + 1, f["last"] - f["first"] + 1)
        return F.array_join(F.zip_with(span(F.col("_words")), span(F.col("_letters")), lambda w, x: F.when(f["named"] & (x == C.NAME_FULL), C.NAME_SHORT[0]).otherwise(w)), " ")

    text = F.array_join(F.transform(F.filter(found, lambda f: f["there"]), told), " … ")
    return step.select("_row.*", F.when(F.coalesce(fits, F.lit(False)), text).alias(free_name(rows, out)))


def cleaned_inline(rows: DataFrame, verses: DataFrame, id_col: str = "id", text: str = "text", refs: str | None = None) -> DataFrame:
    """``rows`` with two last columns, ``cleaned`` and ``is_cleaned`` or longer names that are free: the vocalised quotation inside the text replaced by the corpus's words for it.

    First the corpus is searched for the quotation itself; what that leaves open is aligned to the verses of the
    references in ``refs``, then to a window around these. Each step sees only rows that the step before left open.
    """
    q = rows.select(F.col(id_col).alias("quote_id"), vocalized_quote(F.col(text)).alias("quote"), *([F.col(refs).alias("refs")] if refs else []))
    q = q.where("quote is not null")

    def aligned_to(open_: DataFrame, texts: DataFrame) -> DataFrame:
        return with_alignment(open_.join(texts, "quote_id")).where("aligned is not null").select("quote_id", "aligned")

    done = aligned_to(q, resolved(q, verses).select("quote_id", "text"))
    if refs:
        for widen in (False, True):
            left = q.join(done, "quote_id", "left_anti")
            r = left.select(F.col("quote_id").alias("id"), F.posexplode("refs").alias("pos", "r"))
            r = r.withColumn("r", T.widened(F.col("r"))) if widen else r
            texts = verse_texts(r.select("id", "pos", "r.*"), verses).where("text is not null").select(F.col("id").alias("quote_id"), "text")
            done = done.unionAll(aligned_to(left, texts))
    said, new = free_name(rows, "quote"), free_name(rows, "aligned")
    j = rows.join(q.join(done, "quote_id").select(F.col("quote_id").alias(id_col), F.col("quote").alias(said), F.col("aligned").alias(new)), id_col, "left")
    cleaned = A.spliced(F.col(text), F.col(said), F.col(new))
    return j.withColumn(free_name(rows, "cleaned"), cleaned).withColumn(free_name(rows, "is_cleaned"), F.col(new).isNotNull()).drop(said, new)
