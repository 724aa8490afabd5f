"""From files to documents: reading, choosing the parser, validating, noting what happened, writing.

Every file is a row and every decision a column, so a batch is one plan. A file that can't be read is a stub
document with a note; it doesn't end the batch. Inputs are told apart by ``doc_id``; files that share one
are one document, their pages side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions import text as T
from ..names import free_name
from ..sources import drawn, files, store, transfer
from . import booklets, emphasis, matching, units

_DOCUMENT = ["questionnaire_id", "source_url", "metadata", "sections", "answer_key_present", "answer_key_location", "answer_key_source", "import_provenance"]


def unreadable(kind: Column, pages: Column, error: Column, second_letters: Column, doc: Column) -> Column:
    """Why a file has no text that can be parsed; null if it has. The second reader's letters count, its text isn't used."""
    poor = ~T.readable(F.array_join(F.coalesce(pages, F.array().cast("array<string>")), "\n"))
    return (
        F.when(doc.isin(C.KNOWN_UNREADABLE), "image-based PDF (known from prior research)")
        .when(error.isNotNull(), F.concat(F.lit("extraction error: "), error))
        .when((kind == "pdf") & poor & (second_letters < 40), "image-based PDF -- text layer empty")
        .when((kind == "doc") & poor, "binary .doc -- could not extract text")
    )


def with_failures(docs: DataFrame) -> DataFrame:
    """Documents whose validation errors, if any, lower the quality and go to the notes."""
    errors, prov, own = units.document_errors(docs), F.col("import_provenance"), free_name(docs, "errors")
    note = F.concat(F.lit("validation: "), F.array_join(own, "; "))
    failed = prov.withField("extraction_quality", F.lit("manual_review_needed")).withField("extraction_notes", F.concat_ws("; ", prov["extraction_notes"], note))
    return docs.withColumn(own, errors).withColumn("import_provenance", F.when(F.size(own) > 0, failed).otherwise(prov)).drop(own)


def parsed(texts: DataFrame, fetch_date: str, answers: DataFrame | None = None, urls: DataFrame | None = None) -> DataFrame:
    """Documents of ``files.read_texts`` rows: a stub, a staged booklet or a questionnaire for each, validated.

    ``answers`` (doc_id, qnum, correct_option, refs) are answers from tables; ``urls`` (doc_id, url) says where files came from.
    """
    t = texts.withColumn("_why", unreadable(F.col("kind"), F.col("pages"), F.col("error"), F.col("second_letters"), F.col("doc_id")))
    stubs = units.stub(t.where("_why is not null").select(F.col("doc_id").alias("base"), F.lit(None).cast("string").alias("url"), "_why"), "unreadable", F.col("_why"), fetch_date)
    whole = t.where("_why is null").withColumn("_staged", (F.col("kind") == "pdf") & T.looks_staged(F.col("pages")))
    staged = booklets.staged_documents(files.pages_of(whole.where("_staged")), fetch_date)
    plain = booklets.questionnaires(files.pages_of(whole.where("not _staged")), fetch_date, answers)
    good = with_failures(staged.select(*_DOCUMENT).unionByName(plain.select(*_DOCUMENT)))
    out = good.unionByName(stubs.select(*_DOCUMENT))
    if urls is None:
        return out
    of = urls.groupBy(F.col("doc_id").alias("questionnaire_id")).agg(F.min("url").alias("_url"))
    j = out.join(of, "questionnaire_id", "left")
    return j.withColumn("source_url", F.coalesce("_url", "source_url")).withColumn("import_provenance", F.col("import_provenance").withField("fetched_from", F.col("_url"))).select(*_DOCUMENT)


def drawn_texts(objects: DataFrame) -> DataFrame:
    """The rows of ``files.read_texts`` for documents that ``drawn.read_drawn`` read: page numbers off, lines in reading order."""
    chars, words, pages = (drawn.part_of(objects, k) for k in ("char", "word", "page"))
    told = emphasis.page_texts(chars, words, pages).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda p: p["text"]).alias("pages"))
    files_ = objects.groupBy("doc_id").agg(F.min("file_kind").alias("kind"), F.min(F.when(F.col("kind") == "error", F.col("text"))).alias("error"))
    return files_.join(told, "doc_id", "left").select("doc_id", "kind", "pages", "error", F.lit(0).alias("second_letters"))


def results(entries: DataFrame, docs: DataFrame, done: DataFrame | None = None, force: bool = False) -> DataFrame:
    """id, status, extraction_quality, question_count, suspicious_hebrew for each entry (``base``): what became of it.

    An entry written before is skipped, unless ``force``; one without a document couldn't be fetched.
    """
    walked = units.audit(docs, F.struct("questionnaire_id", "sections", "metadata"), "questionnaire_id").groupBy("questionnaire_id").agg(F.count("*").alias("suspicious_hebrew"))
    told = docs.select("questionnaire_id", F.col("import_provenance.extraction_quality").alias("extraction_quality"), F.size(units.units_of(F.col("sections"))).alias("question_count"))
    told = told.join(walked, "questionnaire_id", "left").withColumnRenamed("questionnaire_id", "base").withColumn("_made", F.lit(True))
    plan = entries.select("base").withColumn("exists", F.lit(False)) if done is None else files.planned(entries.select("base"), done)
    status = F.when(F.col("exists") & ~F.lit(force), "skipped_existing").when(F.col("_made"), "success").otherwise("fetch_failed")
    j = plan.join(told, "base", "left").withColumn("status", status)
    made = F.col("status") == "success"
    return j.select(
        F.col("base").alias("id"), "status", F.when(made, F.col("extraction_quality")).alias("extraction_quality"), F.when(made, F.col("question_count")).otherwise(0).alias("question_count"),
        F.when(made, F.coalesce("suspicious_hebrew", F.lit(0))).alias("suspicious_hebrew"),
    )


def process(spark: SparkSession, path: str, to: str, fetch_date: str, entries: DataFrame | None = None, readers: dict[str, files.Reader] | None = None, second: dict[str, files.Reader] | None = None, force: bool = False, parsers: dict[str, drawn.Parser] | None = None) -> DataFrame:
    """Read the files under ``path``, put the documents that aren't in the store ``to`` yet into it, and return ``results``.

    ``entries`` (base, url) says which files are wanted; without it all are. With ``force`` documents that are there
    are made again and replace the old ones, so the store (``store.read``) has one row for each id. Files are read once, and a batch
    is written beside the store before it goes in; the log is written last. A run that ends early is simply run again.

    Kinds in ``parsers`` are read as they are drawn (``drawn.read_drawn``): their texts come without page numbers, and bold
    and underlined words are marked in their documents.
    """
    batch, log = f"{to}-batch", f"{to}-log"
    plain, marked = files.read_texts(spark, path, readers, second), None
    if parsers:
        drawn.read_drawn(spark, path, parsers).write.mode("overwrite").parquet(f"{batch}/objects")
        objects = spark.read.parquet(f"{batch}/objects")
        marked = emphasis.detected(drawn.part_of(objects, "char"), drawn.part_of(objects, "shape"))
        plain = files.read_texts(spark, path, readers, second, without=tuple(parsers)).unionByName(drawn_texts(objects))
    plain.write.mode("overwrite").parquet(f"{batch}/texts")
    texts = spark.read.parquet(f"{batch}/texts")
    wanted = texts.select(F.col("doc_id").alias("base"), F.lit(None).cast("string").alias("url")).distinct() if entries is None else entries
    done = store.read(spark, to).select(F.col("questionnaire_id").alias("base")) if store.exists(spark, to) else None
    todo = wanted if done is None or force else wanted.join(done, "base", "left_anti")
    mine = texts.join(todo.select(F.col("base").alias("doc_id")).distinct(), "doc_id", "left_semi")
    docs = parsed(mine, fetch_date, urls=todo.select(F.col("base").alias("doc_id"), "url"))
    docs = (docs if marked is None else emphasis.emphasized(docs, marked)).withColumn("json_path", F.concat("questionnaire_id", F.lit(".json")))
    docs.write.mode("overwrite").parquet(f"{batch}/docs")
    made = spark.read.parquet(f"{batch}/docs")
    results(wanted, made, done, force).write.mode("overwrite").parquet(f"{batch}/log")
    store.upsert(made, to, "questionnaire_id")
    spark.read.parquet(f"{batch}/log").write.mode("overwrite").parquet(log)
    return spark.read.parquet(log)


def reclassify(spark: SparkSession, to: str, key: str = "questionnaire_id") -> DataFrame:
    """Give the documents of the store ``to`` what their ids tell and their quality anew; returns the ids changed.

    Only buckets with a document that differs are written anew, each where it is, so a second run changes nothing.
    """
    mine = F.to_json(F.struct("metadata", "import_provenance"))
    was = free_name(store.read(spark, to), "was")

    def change(docs: DataFrame) -> DataFrame:
        return units.reclassified(docs.withColumn(was, mine)).withColumn(was, mine != F.col(was))

    version = store.rewrite(spark, to, change, was)
    told = lambda n, name: store.read(spark, to, n).select(key, F.to_json(F.struct("metadata", "import_provenance")).alias(name))
    return told(version, "now").join(told(version - 1, "was"), key).where("now <> was").select(key)


def answers_from(keys: DataFrame, candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """doc_id, qnum, correct_option, refs, source: answers that another file's table gives, if its count fits.

    ``keys`` (doc_id, qnum, correct_option, refs) are the tables of answer files, ``candidates`` (left_id,
    right_id, place) the ranked pairs of documents and answer files (``matching.paired``), ``counts`` (doc_id, n) the
    questions of each document. The best placed file that has answers and passes the count guard is taken.
    """
    answered = keys.where(~T.blank(F.col("correct_option"))).groupBy(F.col("doc_id").alias("right_id")).agg(F.count("*").alias("n"))
    asked = counts.select(F.col("doc_id").alias("left_id"), F.col("n").alias("expected"))
    best = matching.first_accepted(candidates.join(answered, "right_id").join(asked, "left_id"))
    note = F.concat("right_id", F.lit(" ("), F.col("n").cast("string"), F.lit(" answers)"))
    of = best.select("left_id", F.col("right_id").alias("doc_id"), note.alias("source"))
    return keys.join(of, "doc_id").select(F.col("left_id").alias("doc_id"), "qnum", "correct_option", "refs", "source")


def pilot(docs: DataFrame, lines: DataFrame | None = None, review: DataFrame | None = None, expected: int | None = C.EXPECTED_QUESTIONS) -> DataFrame:
    """Documents with emphasis (``emphasis.detected``) and clean tags, and their ``errors``.

    ``review`` (doc_id, display_number, prompt, options) is a second reading that is merged in first.
    """
    out = docs if review is None else reviewed(docs, review)
    out = out if lines is None else emphasis.emphasized(out, lines)
    return units.sanitized(out).withColumn("errors", units.quiz_errors(expected))


def reviewed(docs: DataFrame, review: DataFrame) -> DataFrame:
    """Documents whose units carry a second reading's clean texts (``matching.merged_review``); documents are told apart by id."""
    found = units.exploded_units(docs).select("doc_id", "pos", "unit.display_number", "unit.prompt", "unit.options")
    one = matching.merged_review(found, review).groupBy("doc_id", "pos").agg(F.max(F.struct("prompt", "options")).alias("told"))
    merged = one.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("pos", "told"))).alias("_new"))
    j = docs.join(merged.withColumnRenamed("doc_id", "questionnaire_id"), "questionnaire_id", "left")

    def section(s: Column, i: Column) -> Column:
        skipped = F.aggregate(F.slice("sections", F.lit(1), i), F.lit(0), lambda n, x: n + F.coalesce(F.size(x["question_units"]), F.lit(0)))

        def unit(u: Column, k: Column) -> Column:
            told = F.element_at("_new", skipped + k)
            return u.withField("prompt", told["prompt"]).withField("options", told["options"])

        return s.withField("question_units", F.transform(s["question_units"], unit))

    return j.withColumn("sections", F.when(F.col("_new").isNotNull(), F.transform("sections", section)).otherwise(F.col("sections"))).select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """The report of ``pilot`` documents: ``units.stats`` with quality and errors. ``units.batch_summary`` sums it up."""
    return units.stats(docs, F.col("import_provenance.extraction_quality").alias("extraction_quality"), F.col("errors"))


def run_batch(
    spark: SparkSession, ids: DataFrame, found: DataFrame, to: str, fetch_date: str, base_url: str = "", review: DataFrame | None = None, expected: int | None = None,
    readers: dict[str, files.Reader] | None = None, parsers: dict[str, drawn.Parser] | None = None, force: bool = False, **fetching,
) -> DataFrame:
    """Fetch, parse and report the documents of ``ids`` (base): one row for each id, with its ``report`` columns and ``error``.

    ``found`` are discovered files (``files.discovered``); ids that aren't there are tried under ``base_url``. Files go
    to ``to/files``, documents to the store ``to/documents``, and each report to ``to/reports/<id>.report.json``. An id
    whose file can't be fetched, or that gives no document, is a row with its error; it doesn't end the batch. Files are
    read as they are drawn by ``parsers``, and a second reading in ``review`` is merged in. ``fetching`` goes to ``transfer.fetched``.
    """
    entries = files.entries_for(ids.select("base").distinct(), found, base_url)
    told = transfer.download(entries, f"{to}/files", **fetching)
    process(spark, f"{to}/files", f"{to}/documents", fetch_date, entries.select("base", "url"), readers, None, force, parsers)
    mine = store.read(spark, f"{to}/documents").join(entries.select(F.col("base").alias("questionnaire_id")), "questionnaire_id", "left_semi")
    made = report(pilot(mine, review=review, expected=expected)).withColumn("_made", F.lit(True))
    failed = told.select("base", F.col("error").alias("_failed"))
    j = entries.select("base").join(failed, "base", "left").join(made.withColumnRenamed("questionnaire_id", "base"), "base", "left")
    error = F.when(F.col("_made").isNull(), F.coalesce("_failed", F.lit("no report produced")))
    out = j.select(F.col("base").alias("questionnaire_id"), *[c for c in made.columns if c not in ("questionnaire_id", "_made")], error.alias("error"))
    out.write.mode("overwrite").parquet(f"{to}/summary")
    reports = spark.read.parquet(f"{to}/summary")
    named = reports.where("error is null").select(F.concat("questionnaire_id", F.lit(".report.json")).alias("name"), F.to_json(F.struct("*")).cast("binary").alias("content"))
    transfer.write_files(named, f"{to}/reports")
    return reports
