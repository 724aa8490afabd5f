"""Operators over nested documents: flattening, predicates, quality, validation, summaries, reports.

Defined results: null sections, units, options and sources are empty lists; null and empty texts are alike blank;
each row is one document, repeated or not, so nothing is lost or joined by an id unless an operator says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from json import loads

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from ..functions import constants as C
from ..functions import text as T


def units_of(sections: Column) -> Column:
    """All units of a document in order; null sections and null unit lists are empty."""
    return F.flatten(F.transform(F.coalesce(sections, F.array()), lambda s: F.coalesce(s["question_units"], F.array())))


def exploded_units(docs: DataFrame) -> DataFrame:
    """doc_id, pos, unit for every unit."""
    rows = docs.select(F.col("questionnaire_id").alias("doc_id"), units_of(F.col("sections")).alias("units"))
    # an inner explode would be given a filter by the optimizer that makes all units once more
    return rows.select("doc_id", F.posexplode_outer("units").alias("pos", "unit")).where("pos is not null")


def texts_of(unit: Column) -> Column:
    """All texts a reader sees of a unit, nulls left out."""
    options = F.transform(F.coalesce(unit["options"], F.array().cast("array<struct<key:string,text:string>>")), lambda o: o["text"])
    answers = F.when(unit["acceptable_answers"].isNotNull(), F.transform(unit["acceptable_answers"], lambda a: a["answer_text"])).otherwise(F.array().cast("array<string>"))
    return F.array_compact(F.concat(F.array(unit["prompt"], unit["narrative_context"]), options, answers))


def _size(c: Column) -> Column:
    return F.when(c.isNull(), 0).otherwise(F.size(c))


def has_four_answers(unit: Column) -> Column:
    return _size(unit["options"]) == 4


def has_correct_answer(unit: Column) -> Column:
    return ~T.blank(unit["correct_option"])


def has_source(unit: Column) -> Column:
    return _size(unit["primary_sources"]) > 0


def is_suspicious(unit: Column) -> Column:
    return F.exists(texts_of(unit), T.detached_or_lost)


def quality(n_units: Column, n_keyed: Column, garbled: Column | None = None) -> Column:
    """No unit or none keyed: manual review; some keyed, or garbled text: partial; else clean."""
    lost = F.lit(False) if garbled is None else garbled
    return F.when((n_units == 0) | (n_keyed == 0), "manual_review_needed").when((n_keyed < n_units) | lost, "partial").otherwise("clean")


def quality_notes(units: Column) -> Column:
    """What the quality was lowered for, joined by ``; `` (null if nothing)."""
    missing = F.transform(F.filter(units, lambda u: u["correct_option"].isNull()), lambda u: u["display_number"])
    keyed = F.size(F.filter(units, lambda u: ~T.blank(u["correct_option"])))
    lost = F.exists(units, lambda u: F.coalesce(u["narrative_context"], F.lit("")).contains(C.LOST))
    first = (
        F.when(F.size(units) == 0, "no question units parsed")
        .when(keyed == 0, "no answer key found (questions only)")
        .when(F.size(missing) > 0, F.concat(F.lit("missing answers for: "), F.array_join(missing, ", ")))
    )
    notes = F.array_compact(F.array(first, F.when(lost, "some narrative verse text could not be enriched; best-effort retained")))
    return F.when(F.size(notes) > 0, F.array_join(notes, "; "))


def manifest(docs: DataFrame, folder: str = "quizzes") -> DataFrame:
    """A row for each document, in order of file names: a projection, nothing is shuffled but for the order."""
    return docs.select(
        F.col("questionnaire_id").alias("id"),
        F.col("metadata.track").alias("track"),
        F.col("metadata.stage").alias("stage"),
        F.col("metadata.contest_year_civil").alias("year_civil"),
        F.col("metadata.contest_year_hebrew").alias("year_hebrew"),
        F.size(units_of(F.col("sections"))).alias("question_count"),
        F.concat(F.lit(f"{folder}/"), "json_path").alias("json_path"),
        F.col("import_provenance.extraction_quality").alias("extraction_quality"),
        F.coalesce("answer_key_present", F.lit(False)).alias("has_answer_key"),
    ).orderBy("json_path")  # the folder before it is the same for all, and no section has to move


def reclassified(docs: DataFrame) -> DataFrame:
    """Documents with what their id tells filled in, and the quality from their units; unreadable ones keep theirs."""
    known = T.decode_id(F.col("questionnaire_id"))
    units = units_of(F.col("sections"))
    keyed = F.size(F.filter(units, has_correct_answer))
    md, prov = F.col("metadata"), F.col("import_provenance")
    year = F.coalesce(md["contest_year_civil"], known["year_civil"])
    filled = (
        md.withField("track", F.coalesce(known["track"], md["track"]))
        .withField("stage", F.coalesce(known["stage"], md["stage"]))
        .withField("contest_year_hebrew", F.when(md["contest_year_civil"].isNull() & known["year_civil"].isNotNull(), T.hebrew_year(year)).otherwise(md["contest_year_hebrew"]))
        .withField("contest_year_civil", year)
    )
    new = F.when(prov["extraction_quality"].eqNullSafe("unreadable"), "unreadable").otherwise(quality(F.size(units), keyed))
    return docs.withColumns({"metadata": filled, "import_provenance": prov.withField("extraction_quality", new)})


def run_log(results: DataFrame) -> DataFrame:
    """One row of counts over the results of a run (id, status, suspicious_hebrew)."""

    def n(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return results.agg(
        F.count("*").alias("total_files"),
        n("success").alias("processed"),
        n("skipped_existing").alias("skipped_existing"),
        n("fetch_failed").alias("failed"),
        F.coalesce(F.sum(F.coalesce("suspicious_hebrew", F.lit(0))), F.lit(0)).alias("suspicious_hebrew_total"),
    )


def furniture(unit: Column) -> Column:
    """(field, text) of the prompt and options of a unit that end with a leaked page number."""
    options = F.transform(
        F.coalesce(unit["options"], F.array().cast("array<struct<key:string,text:string>>")),
        lambda o: F.struct(F.concat(F.lit("option:"), o["key"]).alias("field"), o["text"].alias("text")),
    )
    fields = F.concat(F.array(F.struct(F.lit("prompt").alias("field"), unit["prompt"].alias("text"))), options)
    return F.filter(fields, lambda f: T.ends_with_furniture(f["text"]))


def stats(docs: DataFrame, *more: Column) -> DataFrame:
    """The report's counts for each document, and ``more`` columns."""
    u = units_of(F.col("sections"))

    def n(test) -> Column:
        return F.size(F.filter(u, test))

    leaked = F.flatten(F.transform(u, lambda x: F.transform(furniture(x), lambda f: F.struct(x["unit_id"].alias("unit_id"), f["field"].alias("field"), f["text"].alias("text")))))
    return docs.select(
        F.col("questionnaire_id"),
        F.size(u).alias("questions_detected"),
        n(has_four_answers).alias("with_four_answers"),
        n(has_correct_answer).alias("with_correct_answer"),
        n(has_source).alias("with_source"),
        n(is_suspicious).alias("suspected_rtl_or_corruption"),
        F.transform(F.filter(u, is_suspicious), lambda x: x["unit_id"]).alias("suspicious_unit_ids"),
        F.size(leaked).alias("page_furniture_contamination"),
        leaked.alias("page_furniture_fields"),
        n(lambda x: F.exists(texts_of(x), T.has_tags)).alias("with_html_formatting"),
        *more,
    )


def is_answered(subquestion: Column) -> Column:
    return F.exists(F.coalesce(subquestion["acceptable_answers"], F.array()), lambda a: ~T.blank(a["answer_text"]))


def stage_letters(sections: Column) -> Column:
    """The letters of a staged booklet's stages, each once, in order."""
    letters = F.transform(F.coalesce(sections, F.array()), lambda s: F.regexp_extract(s["section_id"], "^stage_([^_]*)_", 1))
    return F.array_distinct(F.filter(letters, lambda x: x != ""))


def first_few(found: Column, n: int = 3) -> Column:
    """The first ``n`` entries of an array, for display."""
    return F.slice(found, 1, n)


def answered(docs: DataFrame) -> DataFrame:
    """Subquestions, and how many of them have an answer, for each document."""
    subs = F.flatten(F.transform(units_of(F.col("sections")), lambda u: F.coalesce(u["subquestions"], F.array())))
    has = F.filter(subs, is_answered)
    return docs.select("questionnaire_id", F.size(subs).alias("total"), F.size(has).alias("answered"))


def document_errors(docs: DataFrame) -> Column:
    """Errors of a document as the archive checks it, in order: id, year, track, stage, units, their fields, date."""
    md, units = F.col("metadata"), units_of(F.col("sections"))
    year, track, stage = md["contest_year_civil"], md["track"], md["stage"]

    def of_unit(u: Column) -> Column:
        name = F.coalesce(u["unit_id"], F.lit("None"))
        asked = ~T.blank(u["prompt"]) | (_size(u["subquestions"]) > 0) | ~T.blank(u["narrative_context"])
        missing = [F.when(T.blank(u[f]), F.concat(name, F.lit(f" missing {f}"))) for f in ("unit_id", "question_type")]
        return F.array_compact(F.array(*missing, F.when(~asked, F.concat(name, F.lit(" missing prompt")))))

    head = F.array(
        F.when(F.col("questionnaire_id").isNull(), "missing questionnaire_id"),
        F.when(~year.between(C.FIRST_YEAR, C.LAST_YEAR), F.concat(F.lit("year "), year.cast("string"), F.lit(" out of range"))),
        F.when(~track.isin(C.TRACKS), F.concat(F.lit("bad track "), track)),
        F.when(~stage.isin(C.STAGES), F.concat(F.lit("bad stage "), stage)),
        F.when(~F.col("import_provenance.extraction_quality").eqNullSafe("unreadable") & (F.size(units) == 0), "no question units"),
    )
    tail = F.array(F.when(T.blank(F.col("import_provenance.fetch_date")), "no fetch_date"))
    return F.array_compact(F.concat(head, F.flatten(F.transform(units, of_unit)), tail))


def quiz_errors(expected: int | None = C.EXPECTED_QUESTIONS) -> Column:
    """Errors of a multiple-choice document: the number of questions, then each unit's in order."""
    units = units_of(F.col("sections"))
    keys = C.OPTION_KEYS[:4]
    ids = F.transform(units, lambda u: F.when(T.blank(u["unit_id"]), "?").otherwise(u["unit_id"]))

    def of_unit(u: Column, i: Column) -> Column:
        name = ids[i]
        options = F.coalesce(u["options"], F.array().cast("array<struct<key:string,text:string>>"))

        def error(test: Column, *text) -> Column:
            return F.when(test, F.concat(name, F.lit(": "), *[t if isinstance(t, Column) else F.lit(t) for t in text]))

        empty = F.transform(F.filter(options, lambda o: T.trim(F.coalesce(o["text"], F.lit(""))) == ""), lambda o: F.concat(name, F.lit(": empty option '"), o["key"], F.lit("'")))
        co = u["correct_option"]
        choice = F.coalesce(
            error(T.blank(co), "missing correct_option"),
            error(~co.isin(keys), "correct_option '", co, "' not in ", str(tuple(keys))),
        )
        lost = error(F.exists(texts_of(u), lambda t: t.contains(C.LOST)), "replacement char in text")
        before = F.array(
            error(F.array_contains(F.slice(ids, F.lit(1), i), name), "duplicate unit_id"),
            error(T.trim(F.coalesce(u["prompt"], F.lit(""))) == "", "empty prompt"),
            error(F.size(options) != 4, F.size(options).cast("string"), " options (expected 4)"),
        )
        return F.array_compact(F.concat(before, empty, F.array(choice, lost)))

    count = F.lit(None).cast("string")
    if expected is not None:
        count = F.when(F.size(units) != expected, F.concat(F.lit(f"expected {expected} questions, found "), F.size(units).cast("string")))
    return F.concat(F.array_compact(F.array(count)), F.flatten(F.transform(units, of_unit)))


def sanitized(docs: DataFrame) -> DataFrame:
    """Documents whose prompts, narratives and options keep emphasis only where its tags are valid."""

    def unit(u: Column) -> Column:
        options = F.when(u["options"].isNotNull(), F.transform(u["options"], lambda o: o.withField("text", T.sanitize(o["text"]))))
        return u.withField("prompt", T.sanitize(u["prompt"])).withField("narrative_context", T.sanitize(u["narrative_context"])).withField("options", options)

    sections = F.transform("sections", lambda s: s.withField("question_units", F.transform(s["question_units"], unit)))
    return docs.withColumn("sections", sections)


_FOUND = "array<struct<path:string,snippet:string>>"


def _suspects(c: Column, kind: DataType, path: Column) -> Column | None:
    """The texts in ``c`` that ``audit`` looks for, as an array of (path, snippet); null where the type has no text at all."""
    none = F.array().cast(_FOUND)
    if isinstance(kind, StringType):
        return F.when(T.detached_or_lost(c), F.array(F.struct(path.alias("path"), F.substring(c, 1, 60).alias("snippet")))).otherwise(none)
    if isinstance(kind, StructType):
        parts = [_suspects(c.getField(f.name), f.dataType, F.concat(path, F.lit(f".{f.name}"))) for f in kind.fields]
        parts = [p for p in parts if p is not None]
        return F.concat(*parts) if parts else None
    if isinstance(kind, ArrayType):
        if _suspects(c, kind.elementType, path) is None:
            return None
        each = F.transform(c, lambda x, i: _suspects(x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        return F.coalesce(F.flatten(each), none)
    if isinstance(kind, MapType):
        if _suspects(c, kind.valueType, path) is None:
            return None
        each = F.transform(F.map_entries(c), lambda e: _suspects(e["value"], kind.valueType, F.concat(path, F.lit("."), e["key"].cast("string"))))
        return F.coalesce(F.flatten(each), none)
    return None


def audit(docs: DataFrame, doc: Column, id_col: str) -> DataFrame:
    """id, path, snippet (60 characters) of every text anywhere in ``doc`` with a detached mark or a lost character.

    The type of ``doc`` says where texts are, so this is one expression in the JVM; arrays and maps may be of any length.
    A JSON text without a type is walked by ``walk``.
    """
    typed = docs.select(F.col(id_col).alias("id"), doc.alias("doc"))
    found = _suspects(F.col("doc"), typed.schema["doc"].dataType, F.lit(""))
    each = typed.select("id", F.explode_outer(F.array().cast(_FOUND) if found is None else found).alias("f")).where("f is not null")
    return each.select(F.col("id").alias(id_col), "f.path", "f.snippet")


def _scalars(json: str | None) -> Iterator[tuple[str, str | None]]:
    """(path, value) of every scalar, in order; numbers as they are written."""
    if json is None:
        return
    todo = [("", loads(json, parse_int=str, parse_float=str, parse_constant=str))]
    while todo:
        path, x = todo.pop()
        if isinstance(x, dict):
            todo += reversed([(f"{path}.{k}", v) for k, v in x.items()])
        elif isinstance(x, list):
            todo += reversed([(f"{path}[{i}]", v) for i, v in enumerate(x)])
        else:
            yield path, x if x is None or isinstance(x, str) else str(x).lower()


def walk(rows: DataFrame, id_col: str, json: str = "json") -> DataFrame:
    """id, path, value of every scalar of a JSON column, ``.key`` and ``[i]`` steps in the path, however deep.

    One Arrow pass: a level has no branch of its own, so the plan doesn't grow with the depth. A null document
    has no scalars, a null inside one has a null value; numbers keep their digits as written; of keys that
    repeat in one object the last holds. Text that isn't JSON fails.
    """
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, *x) for i, text in enumerate(b.column(1)) for x in _scalars(text.as_py())]
            at, path, value = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(path, pa.string()), pa.array(value, pa.string())], names=[id_col, "path", "value"])

    return rows.select(id_col, json).mapInArrow(run, f"`{id_col}` {kind}, path string, value string")


def batch_summary(reports: DataFrame) -> DataFrame:
    """Counts over a batch's reports, for each extraction quality."""
    return reports.groupBy("extraction_quality").agg(F.count("*").alias("n"), F.sum("questions_detected").alias("questions"), F.sum(F.size("errors")).alias("errors")).orderBy("extraction_quality")


def stub(ids: DataFrame, quality_: str, notes: str | Column, fetch_date: str) -> DataFrame:
    """Documents without sections for (base, url) rows: what the id tells, a quality and a note."""
    from .. import schema

    m = T.decode_id(F.col("base"))
    none = F.lit(None)
    filled = F.struct(
        m["year_civil"].alias("contest_year_civil"), T.hebrew_year(m["year_civil"]).alias("contest_year_hebrew"), m["track"].alias("track"), m["stage"].alias("stage"),
        none.alias("sitting"), m["age_group"].alias("age_group"), none.alias("annual_theme"),
        F.struct(none.alias("program_supervisor"), none.alias("quiz_coordinator"), F.array().alias("question_authors"), none.alias("editor"), F.array().alias("committee_members")).alias("credits"),
        F.array().alias("syllabus"), none.alias("time_limit_minutes"), none.alias("instructions_text"), none.alias("source_text_edition"),
        F.struct(none.alias("points_per_question"), none.alias("max_points"), F.lit(False).alias("scoring_is_tiered")).alias("scoring_summary"),
    )
    origin = F.struct(F.col("url").alias("fetched_from"), F.lit(fetch_date).alias("fetch_date"), F.lit(quality_).alias("extraction_quality"), (notes if isinstance(notes, Column) else F.lit(notes)).alias("extraction_notes"))
    return ids.select(
        F.col("base").alias("questionnaire_id"), F.col("url").alias("source_url"), filled.cast(schema.METADATA).alias("metadata"),
        F.array().cast(f"array<{schema.SECTION}>").alias("sections"), F.lit(False).alias("answer_key_present"), F.lit("none").alias("answer_key_location"),
        F.lit(None).cast("string").alias("answer_key_source"), origin.alias("import_provenance"),
    )
