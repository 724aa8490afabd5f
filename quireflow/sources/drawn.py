"""Pages as they are drawn: characters, words and rules of files as rows, by a parser that is passed in.

A parser turns the bytes of a file into pages (``Page``). It runs in a table function over ``binaryFile``, so a file of
any number of pages is a stream of rows, and what follows (page numbers off, lines in reading order, emphasis) are
joins and aggregates over these rows.

Defined results: a file that the parser fails on is one row of kind ``error`` with the message, and no other. A page
without characters is a row of kind ``page``. Files of no kind in ``parsers`` are left out. Two files of one name are one document.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OBJECT = "kind string, page_no int, no int, text string, x0 double, x1 double, top double, bottom double, fontname string"
NAMES = [f.split(" ")[0] for f in OBJECT.split(", ")]
TYPES = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}
#: Rows of a batch that goes out.
ROWS = 5000
#: A file's document: its name without the extension (an SQL expression over its path).
DOC = r"regexp_extract(path, '([^/]+)[.][^./]+$', 1)"


@dataclass
class Page:
    """What is on a page: chars as (text, x0, x1, top, bottom, fontname), words as (text, x0, x1, top, bottom), shapes as (x0, x1, top, bottom)."""

    height: float
    chars: list[tuple] = field(default_factory=list)
    words: list[tuple] = field(default_factory=list)
    shapes: list[tuple] = field(default_factory=list)


Parser = Callable[[bytes], Iterable[Page]]


def plumbed(content: bytes) -> Iterator[Page]:
    """The pages of a PDF by pdfplumber, where that is installed."""
    import pdfplumber

    box = ("x0", "x1", "top", "bottom")
    with pdfplumber.open(io.BytesIO(content)) as pdf:
        for p in pdf.pages:
            chars = [(c["text"], *map(c.get, box), c.get("fontname")) for c in p.chars]
            words = [(w["text"], *map(w.get, box)) for w in p.extract_words()]
            yield Page(float(p.height), chars, words, [tuple(map(s.get, box)) for s in [*p.rects, *p.lines]])


def _rows(pages: Iterable[Page]) -> Iterator[tuple]:
    for n, p in enumerate(pages):
        yield ("page", n, 0, None, None, None, 0.0, float(p.height), None)
        for i, c in enumerate(p.chars):
            yield ("char", n, i, *c)
        for i, w in enumerate(p.words):
            yield ("word", n, i, *w, None)
        for i, s in enumerate(p.shapes):
            yield ("shape", n, i, None, *s, None)


def _table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.string(), pa.string(), *[TYPES[f.split(" ")[1]] for f in OBJECT.split(", ")]]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "file_kind", *NAMES])


def read_drawn(spark: SparkSession, path: str, parsers: dict[str, Parser], doc: str = DOC) -> DataFrame:
    """doc_id, file_kind and the columns of ``OBJECT``: a row for each page, character, word and shape of the files under ``path``.

    ``parsers`` says by extension who reads a file, ``doc`` which document a ``path`` is. A page's height is its ``bottom``.
    """

    @F.arrow_udtf(returnType=f"doc_id string, file_kind string, {OBJECT}")
    class Objects:
        def eval(self, files: pa.RecordBatch) -> Iterator[pa.Table]:
            for doc, kind, data in zip(*[c.to_pylist() for c in files.columns]):
                try:
                    rows = list(_rows(parsers[kind](data)))
                except Exception as e:  # one broken file is that file's result, not the job's end
                    rows = [("error", None, None, str(e), None, None, None, None, None)]
                for i in range(0, len(rows), ROWS):
                    yield _table([(doc, kind, *r) for r in rows[i : i + ROWS]])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    kind = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    mine = files.select(F.expr(doc).alias("doc_id"), kind.alias("file_kind"), "content").where(F.col("file_kind").isin(*parsers))
    return Objects(mine.asTable())


def part_of(objects: DataFrame, kind: str) -> DataFrame:
    """The rows of one kind (char, word, shape or page), with the names that ``operators.emphasis`` reads."""
    rows = objects.where(F.col("kind") == kind)
    if kind == "page":
        return rows.select("doc_id", "page_no", F.col("bottom").alias("height"))
    return rows.select("doc_id", "page_no", F.col("no").alias(f"{kind}_no"), "text", "x0", "x1", "top", "bottom", "fontname")
