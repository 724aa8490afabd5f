"""Sources and sinks: page text from files, nested JSON documents, a verse corpus, links and their files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema
from ..functions import arrow as A
from ..functions import constants as C
from ..functions import text as T
from ..names import free_name


def extension(path: Column) -> Column:
    """pdf, docx, doc or other."""
    ext = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return F.when(ext.isin("pdf", "docx", "doc"), ext).otherwise("other")


def docx_text(content: bytes) -> list[str]:
    """One page: the paragraphs of the document part, joined by line ends."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    body = root.find(f"{w}body")
    paragraphs = body.findall(f"{w}p") if body is not None else []
    return ["\n".join("".join(t.text or "" for t in p.iter(f"{w}t")) for p in paragraphs)]


def doc_text(content: bytes) -> list[str]:
    """One page: a file named so may hold the newer format; anything else gives an empty page."""
    try:
        return docx_text(content)
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return [""]


def pdf_text(content: bytes) -> list[str]:
    """Text of each page, by a reader that is installed (pypdf); without one this fails loudly."""
    from pypdf import PdfReader

    return [p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages]


Reader = Callable[[bytes], list[str]]
READERS: dict[str, Reader] = {"docx": docx_text, "doc": doc_text, "pdf": pdf_text}
#: Kinds whose lines come as they are drawn, from right to left.
DRAWN = ("pdf",)


def read_texts(spark: SparkSession, path: str, readers: dict[str, Reader] | None = None, second: dict[str, Reader] | None = None, drawn: tuple[str, ...] = DRAWN, without: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, kind, pages, error, second_letters: a row for each file under ``path`` of a known kind that isn't in ``without``.

    ``readers`` replaces or adds what turns a file's bytes into page texts; lines of kinds in ``drawn`` are put
    in reading order. Where a page text has too few letters to be read (``text.readable``), the reader in
    ``second`` is asked as well, only for the number of letters it finds. A reader that fails gives no page and its message in ``error``.
    """
    known, other = {k: r for k, r in (READERS | (readers or {})).items() if k not in without}, second or {}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = files.select("path", "content", F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("kind")).where(F.col("kind").isin(*known))

    def attempt(reader: Reader, content: bytes) -> tuple[list[str] | None, str | None]:
        try:
            return reader(bytes(content)), None
        except Exception as e:  # one broken file is that file's result, not the job's end
            return None, str(e)

    def pages(content: pd.Series, kind: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([attempt(known[k], c) for c, k in zip(content, kind)], columns=["pages", "error"])

    def again(content: pd.Series, kind: pd.Series) -> pd.Series:
        return pd.Series(["\n".join(attempt(other[k], c)[0] or []) if k in other else "" for c, k in zip(content, kind)], dtype=object)

    read = files.withColumn("r", F.pandas_udf(pages, "struct<pages:array<string>,error:string>")("content", "kind"))
    poor = ~T.readable(F.array_join("r.pages", "\n"))
    asked = read.withColumn("more", F.pandas_udf(again, "string")(F.when(poor, F.col("content")).otherwise(F.lit(b"")), F.when(poor, F.col("kind")).otherwise(F.lit(""))))
    lines = lambda p: F.array_join(F.transform(F.split(p, "\n"), T.turned), "\n")
    texts = F.when(F.col("kind").isin(*drawn), F.transform("r.pages", lines)).otherwise(F.col("r.pages"))
    doc = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    return asked.select(doc.alias("doc_id"), "kind", texts.alias("pages"), F.col("r.error").alias("error"), T.letter_count(F.col("more")).alias("second_letters"))


def pages_of(texts: DataFrame) -> DataFrame:
    """doc_id, page_no, text for every page of ``read_texts``, in composed form."""
    return texts.select("doc_id", F.posexplode("pages").alias("page_no", "text")).withColumn("text", A.nfc(F.col("text")))


def read_pages(spark: SparkSession, path: str, readers: dict[str, Reader] | None = None, drawn: tuple[str, ...] = DRAWN) -> DataFrame:
    """doc_id, page_no, text for every page of the files under ``path``; files of no known kind, or that can't be read, give none."""
    return pages_of(read_texts(spark, path, readers, None, drawn))


def resolved_input(path: Column, known: Column) -> Column:
    """(base, filename, source_url, is_local): the input that an address or a local file names.

    ``known`` is the file name of a copy that is there already, if any: then nothing has to be fetched.
    """
    filename = F.regexp_extract(F.regexp_replace(path, "/+$", ""), "([^/]+)$", 1)
    local = ~path.rlike("^[a-z]+://")
    url = F.when(local, F.concat(F.lit("file://"), path)).otherwise(path)
    return F.struct(F.regexp_replace(filename, r"\.[^.]*$", "").alias("base"), filename.alias("filename"), url.alias("source_url"), (local | known.eqNullSafe(filename)).alias("is_local"))


def read_documents(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Nested documents, one file each, or with ``lines`` one line each; the manifest among the files is left out.

    Columns of ``schema.DOCUMENT`` and ``json_path``; fields that a document lacks are null.
    """
    rows = spark.read.schema(schema.DOCUMENT).option("multiLine", str(not lines).lower()).option("pathGlobFilter", "*.json").json(path)
    name = F.col("_metadata.file_name")
    return rows.where(name != "manifest.json").select("*", name.alias("json_path"))


def read_verses(spark: SparkSession, path: str) -> DataFrame:
    """A verse corpus of JSON lines; ``niqqud`` or else ``text_with_niqqud``; empty lines are skipped.

    ``idx`` counts the verses as the files have them: by file name, then by place. Splits of a file are
    numbered each for itself and moved by the lines before them, so no task reads the whole corpus.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("m"))
    lines = lines.where(T.trim(F.col("value")) != "")
    sizes = lines.groupBy("f", "b").agg(F.count("*").alias("n"))
    # one row for each split of a file
    before = F.coalesce(F.sum("n").over(Window.orderBy("f", "b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.withColumn("k", F.row_number().over(Window.partitionBy("f", "b").orderBy("m"))).join(sizes.select("f", "b", before.alias("before")), ["f", "b"])
    v = F.from_json("value", schema.VERSE)
    rows = placed.select((F.col("before") + F.col("k") - 1).alias("idx"), v.alias("v")).select("idx", "v.*")
    text = T.clean_points(F.coalesce(F.nullif(F.col("niqqud"), F.lit("")), F.col("text_with_niqqud")))
    return rows.select("idx", "book", "chapter", "verse", text.alias("niqqud"))


def kept_verses(spark: SparkSession, path: str, to: str) -> DataFrame:
    """The corpus of ``read_verses``, kept as Parquet in ``to``: read from there if it is."""
    if not exists(spark, to):
        read_verses(spark, path).write.mode("overwrite").parquet(to)
    return spark.read.parquet(to)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished table is there, in whatever store the path names."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def trim_verses(spark: SparkSession, path: str, to: str) -> None:
    """Four columns of each verse that has text, without the mark that ends a verse, as JSON lines."""
    rows = spark.read.schema(schema.VERSE).json(path)
    text = T.trim(F.regexp_replace(F.coalesce("text_with_niqqud", F.lit("")), "\\u05C3", ""))
    rows.select("book", "chapter", "verse", text.alias("niqqud")).where("niqqud <> ''").write.json(to)


def write_documents(docs: DataFrame, to: str) -> None:
    """Nested documents as JSON lines, nulls kept."""
    docs.write.option("ignoreNullFields", "false").json(to)


#: What a link's address ends with, and the folder it must name.
FILE_NAME, FILE_FOLDER = r"(?i)/([^/]+\.(?:pdf|docx?))$", "/files/"


def discovered(pages: DataFrame, order: str = "page_id", html: str = "html", base_url: str = "", name: str = FILE_NAME, folder: str = FILE_FOLDER, answers: str = C.ANSWER_FILE) -> DataFrame:
    """base, filename, url, is_answer_key, page, pos: files that pages link to, each base once, by the first page and place.

    Only links under a files folder count; a link without a scheme is taken under ``base_url``. Pages without
    HTML have no links.
    """
    hrefs = F.regexp_extract_all(F.col(html), F.lit("(?i)<a\\s[^>]*?href=[\"']([^\"']*)[\"']"), 1)
    links = pages.select(F.col(order).alias("page"), F.posexplode(hrefs).alias("pos", "href"))
    rows = links.where(F.col("href").contains(folder)).withColumn("filename", F.regexp_extract("href", name, 1)).where("filename <> ''")
    base = F.regexp_replace("filename", r"(?i)\.(pdf|docx?)$", "")
    url = F.when(F.col("href").startswith("http"), F.col("href")).otherwise(F.concat(F.lit(base_url), F.col("filename")))
    full = rows.select(base.alias("base"), "filename", url.alias("url"), base.rlike("(?i)" + answers).alias("is_answer_key"), "page", "pos")
    first = F.min_by(F.struct("filename", "url", "is_answer_key", "page", "pos"), F.struct("page", "pos"))
    return full.groupBy("base").agg(first.alias("f")).select("base", "f.*")


def entries_for(ids: DataFrame, found: DataFrame, base_url: str = "") -> DataFrame:
    """base, filename, url, age_group, is_answer_key for each id (``base``): as discovered, else a guess under ``base_url``."""
    known = found.select("base", "filename", "url", "is_answer_key")
    j = ids.select("base").join(known, "base", "left")
    guess = F.concat("base", F.lit(".pdf"))
    age = F.coalesce(T.decode_id(F.col("base"))["age_group"], F.lit("youth"))
    return j.select(
        "base", F.coalesce("filename", guess).alias("filename"), F.coalesce("url", F.concat(F.lit(base_url), guess)).alias("url"), age.alias("age_group"),
        F.coalesce("is_answer_key", F.lit(False)).alias("is_answer_key"),
    )


def planned(entries: DataFrame, done: DataFrame, key: str = "base") -> DataFrame:
    """``entries`` with a last column, ``exists`` or a longer name that is free: whether a result was written already. What a dry run shows; nothing is processed."""
    own = free_name(entries, "seen")
    seen = done.select(F.col(key)).distinct().withColumn(own, F.lit(True))
    return entries.join(seen, key, "left").withColumn(free_name(entries, "exists"), F.coalesce(own, F.lit(False))).drop(own)
