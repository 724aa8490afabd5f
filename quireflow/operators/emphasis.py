"""Emphasis: words drawn bold or underlined, found from characters and rules on the page and marked in documents.

Characters are rows (doc_id, page_no, char_no, text, x0, x1, top, bottom, fontname), rules rows (doc_id,
page_no, x0, x1, top, bottom). Defined results: characters with a null text or coordinate are left out;
a null font is not bold; repeated characters are drawn twice, so they stand twice in a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrow as A
from ..functions import text as T
from ..names import free_name
from . import matching

#: Points between the tops of a line's first and any other character, and between two characters of a word.
LINE_HEIGHT, WORD_GAP = 3.0, 2.5


def is_bold(font: Column) -> Column:
    return F.coalesce(F.lower(font).contains("bold"), F.lit(False))


def lines_of_chars(chars: DataFrame, height: float = LINE_HEIGHT) -> DataFrame:
    """``chars`` with ``line_no``: from top to bottom, a character within ``height`` of the line's first one joins the line.

    The first character of a line is its anchor, so this is a fold over a page's characters; only the
    places where lines start are kept in it.
    """
    sound = chars.dropna(subset=["text", "x0", "x1", "top", "bottom"])
    row = F.struct(F.bround("top").alias("at"), F.col("x0").alias("left"), "char_no", F.struct("text", "x0", "x1", "top", "bottom", "fontname").alias("c"))
    pages = sound.groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(row)).alias("cs"))
    zero = F.struct(F.lit(None).cast("double").alias("anchor"), F.array().cast("array<int>").alias("starts"))

    def step(a: Column, x: Column) -> Column:
        top = x["c"]["top"].cast("double")
        joins = F.coalesce(F.abs(top - a["anchor"]) <= height, F.lit(False))
        return F.when(joins, a).otherwise(F.struct(top.alias("anchor"), F.array_append(a["starts"], x["i"]).alias("starts")))

    placed = F.transform("cs", lambda c, i: F.struct(c["c"].alias("c"), i.alias("i")))
    pages = pages.select("doc_id", "page_no", placed.alias("cs")).withColumn("starts", F.aggregate("cs", zero, step, lambda a: a["starts"]))
    lines = F.transform("starts", lambda at, k: F.slice("cs", at + 1, F.coalesce(F.get("starts", k + 1), F.size("cs")) - at))
    each = pages.select("doc_id", "page_no", F.posexplode(lines).alias("line_no", "line"))
    return each.select("doc_id", "page_no", "line_no", F.explode("line").alias("x")).select("doc_id", "page_no", "line_no", F.col("x.i").alias("char_no"), "x.c.*")


def words_of_chars(lines: DataFrame, gap: float = WORD_GAP) -> DataFrame:
    """doc_id, page_no, line_no, word_no, text, x0, x1, top, bottom, bold of the words of ``lines_of_chars``, from left to right.

    A blank character or a gap ends a word. A word is bold if half its characters are, one at least. Its
    text is in reading order; a word that is blank then is left out.
    """
    w = Window.partitionBy("doc_id", "page_no", "line_no").orderBy("x0", "char_no")
    blank = F.col("text").rlike(r"(?U)^\s*$")
    s = lines.withColumn("_blank", blank).withColumn("_before", F.lag("x1").over(w)).withColumn("_after_blank", F.lag("_blank").over(w))
    opens = F.coalesce(F.col("_after_blank") | (F.col("x0") - F.col("_before") > gap), F.lit(True))
    s = s.withColumn("word_no", F.sum(opens.cast("int")).over(w)).where("not _blank")
    drawn = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "char_no", "text"))), lambda c: c["text"]), "")
    n, bold = F.count("*"), F.count_if(is_bold(F.col("fontname")))
    out = s.groupBy("doc_id", "page_no", "line_no", "word_no").agg(
        drawn.alias("_drawn"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("top").alias("top"), F.max("bottom").alias("bottom"),
        (bold >= F.greatest(F.lit(1), F.floor(n / 2))).alias("bold"),
    )
    return out.withColumn("text", T.trim(A.logical(F.col("_drawn")))).where("text <> ''").drop("_drawn")


def line_texts(lines: DataFrame) -> DataFrame:
    """doc_id, page_no, line_no, line of ``lines_of_chars``: each line in reading order."""
    drawn = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "char_no", "text"))), lambda c: c["text"]), "")
    return lines.groupBy("doc_id", "page_no", "line_no").agg(drawn.alias("_drawn")).select("doc_id", "page_no", "line_no", A.logical(F.col("_drawn")).alias("line"))


def page_texts(chars: DataFrame, words: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, page_no, text of drawn pages: page numbers go, lines come in reading order; a page without characters is empty.

    ``words`` (text, x0, x1, top, bottom) and ``pages`` (height) say where page numbers stand.
    """
    lines = line_texts(lines_of_chars(matching.without_page_numbers(chars, words, pages)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")
    of = lines.groupBy("doc_id", "page_no").agg(text.alias("text"))
    return pages.select("doc_id", "page_no").join(of, ["doc_id", "page_no"], "left").select("doc_id", "page_no", F.coalesce("text", F.lit("")).alias("text"))


def detected(chars: DataFrame, shapes: DataFrame) -> DataFrame:
    """doc_id, page_no, line_no, line, spans (text, bold, underline) of every line that has an emphasised word."""
    lines = lines_of_chars(chars)
    found = matching.underlined(words_of_chars(lines).withColumn("word_no", F.struct("line_no", "word_no")), matching.thin_rules(shapes))
    found = found.where("bold or underline").select("doc_id", "page_no", F.col("word_no.line_no").alias("line_no"), F.struct(F.col("word_no.word_no").alias("at"), "text", "bold", "underline").alias("s"))
    spans = F.transform(F.array_sort(F.collect_list("s")), lambda s: F.struct(s["text"].alias("text"), s["bold"].alias("bold"), s["underline"].alias("underline")))
    return found.groupBy("doc_id", "page_no", "line_no").agg(spans.alias("spans")).join(line_texts(lines), ["doc_id", "page_no", "line_no"]).select("doc_id", "page_no", "line_no", "line", "spans")


def emphasized(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """Nested documents whose prompts and narratives carry the emphasis of ``detected`` lines; options never do.

    An emphasised option marks the right answer in solutions, so options are not even looked at.
    Documents without emphasis, sections and units come through as they are; so do repeated rows. Documents meet their
    lines once, and only the texts of those that have some go through Python.
    """
    order = F.array_sort(F.collect_list(F.struct("page_no", "line_no", "line", "spans")))
    of = lines.groupBy(F.col("doc_id").alias("questionnaire_id")).agg(F.transform(order, lambda x: F.struct(x["line"].alias("line"), x["spans"].alias("spans"))).alias("_lines"))
    own, told = free_name(docs, "lines"), free_name(docs, "told")
    j = docs.join(of.withColumnRenamed("_lines", own), "questionnaire_id", "left")
    texts = F.transform("sections", lambda s: F.transform(s["question_units"], lambda u: F.array(u["prompt"], u["narrative_context"])))
    j = j.withColumn(told, A.emphasized_units(F.when(F.col(own).isNotNull(), texts), F.col(own)))

    def unit(u: Column, text: Column) -> Column:
        return u.withField("prompt", text[0]).withField("narrative_context", text[1])

    def section(s: Column, i: Column) -> Column:
        return s.withField("question_units", F.transform(s["question_units"], lambda u, k: unit(u, F.get(F.get(told, i), k))))

    return j.withColumn("sections", F.when(F.col(told).isNotNull(), F.transform("sections", section)).otherwise(F.col("sections"))).select(*docs.columns)
