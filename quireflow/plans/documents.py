"""Queries over nested documents: units, reports, validation, manifests, reviews, emphasis, whole builders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import booklets, emphasis, matching, processing, units
from ..session import scratch
from ..sources import store
from .base import ORACLES, UNITS_SQL, hebrew, packed_lines, query, quiz_columns, quizzes, t

_MARK, _LOST = "[\\x{0591}-\\x{05C7}]", "\\x{FFFD}"
_TEXTS = "list_filter(list_concat([prompt, narrative], list_transform(opts, lambda x: x.text), [answer]), lambda x: x is not null)"
_BAD = f"regexp_matches(x, '\\s{_MARK}|{_LOST}')"
_FURNITURE = "[\\x{05D0}-\\x{05EA}]\\s+[0-9]{1,3}\\s*$"


@query(f"""{UNITS_SQL} select o, pos, unit_id, len({_TEXTS}) n_texts, coalesce(n_options, 0) = 4 four, coalesce(correct, '') <> '' keyed, coalesce(n_sources, 0) > 0 sourced,
len(list_filter({_TEXTS}, lambda x: {_BAD})) > 0 suspicious from u""")
def unit_rows(spark, d):
    u = F.col("unit")
    rows = units.exploded_units(quizzes(spark, d).withColumn("questionnaire_id", F.col("o"))).withColumnRenamed("doc_id", "o")
    return rows.select(
        "o", F.col("pos").cast("long").alias("pos"), "unit.unit_id", F.size(units.texts_of(u)).cast("long").alias("n_texts"), units.has_four_answers(u).alias("four"), units.has_correct_answer(u).alias("keyed"),
        units.has_source(u).alias("sourced"), units.is_suspicious(u).alias("suspicious"),
    )


@query(f"""{UNITS_SQL}, f as (select *, len(list_filter({_TEXTS}, lambda x: {_BAD})) > 0 bad, list_concat(case when kind = 2 then ['prompt'] else [] end,
list_transform(list_filter(opts, lambda x: regexp_matches(x.text, '{_FURNITURE}')), lambda x: 'option:' || x.key)) leaked from u),
g as (select o, count(*) n, count(*) filter (where coalesce(n_options, 0) = 4) four, count(*) filter (where coalesce(correct, '') <> '') keyed, count(*) filter (where coalesce(n_sources, 0) > 0) sourced,
count(*) filter (where bad) bad, coalesce(string_agg(unit_id, ',' order by pos) filter (where bad), '') bad_ids, cast(sum(len(leaked)) as bigint) n_leaked,
coalesce(string_agg(array_to_string(list_transform(leaked, lambda x: unit_id || '/' || x), '+'), '+' order by pos) filter (where len(leaked) > 0), '') leaks, count(*) filter (where kind in (3, 4, 5)) html from f group by o)
select d.o, coalesce(n, 0) questions_detected, coalesce(four, 0) with_four_answers, coalesce(keyed, 0) with_correct_answer, coalesce(sourced, 0) with_source, coalesce(bad, 0) suspected,
coalesce(bad_ids, '') suspicious_ids, coalesce(n_leaked, 0) contamination, coalesce(leaks, '') leaks, coalesce(html, 0) with_html, quality from d left join g on d.o = g.o""")
def doc_stats(spark, d):
    s = units.stats(quizzes(spark, d), F.col("o"), F.col("import_provenance.extraction_quality").alias("quality"))
    leaks = F.array_join(F.transform("page_furniture_fields", lambda x: F.concat(x["unit_id"], F.lit("/"), x["field"])), "+")
    n = lambda c, name: F.col(c).cast("long").alias(name)
    return s.select(
        "o", n("questions_detected", "questions_detected"), n("with_four_answers", "with_four_answers"), n("with_correct_answer", "with_correct_answer"), n("with_source", "with_source"),
        n("suspected_rtl_or_corruption", "suspected"), F.array_join("suspicious_unit_ids", ",").alias("suspicious_ids"), n("page_furniture_contamination", "contamination"), leaks.alias("leaks"),
        n("with_html_formatting", "with_html"), "quality",
    )


@query(f"""{UNITS_SQL}, s as (select o, partkey, unnest(range(1, n_subs + 1)) j from u where n_subs is not null)
select d.o, coalesce(n, 0) total, coalesce(a, 0) answered from d left join (select o, count(*) n, count(*) filter (where (partkey + j) % 5 <> 0 and (partkey + j) % 2 = 0) a from s group by o) g on d.o = g.o""")
def answered(spark, d):
    docs = quizzes(spark, d).withColumn("questionnaire_id", F.col("o"))
    return units.answered(docs).select(F.col("questionnaire_id").alias("o"), F.col("total").cast("long").alias("total"), F.col("answered").cast("long").alias("answered"))


_NAME = "coalesce(unit_id, 'None')"


@query(f"""{UNITS_SQL}, e as (select o, string_agg(x, '; ' order by pos, i) x from (select o, pos, 1 i, {_NAME} || ' missing unit_id' x from u where coalesce(unit_id, '') = '' union all
select o, pos, 2, {_NAME} || ' missing question_type' from u where coalesce(qtype, '') = '' union all
select o, pos, 3, {_NAME} || ' missing prompt' from u where coalesce(prompt, '') = '' and coalesce(narrative, '') = '' and n_subs is null) group by o)
select d.o, concat_ws('; ', case when id is null then 'missing questionnaire_id' end, case when not civil between 2008 and 2026 then 'year ' || civil || ' out of range' end,
case when track = 'other' then 'bad track other' end, case when stage = 'final' then 'bad stage final' end,
case when quality <> 'unreadable' and not exists (select 1 from u where u.o = d.o) then 'no question units' end, e.x, case when fetched = '' then 'no fetch_date' end) errors from d left join e on d.o = e.o""")
def validate_orders(spark, d):
    docs = quizzes(spark, d)
    return docs.select("o", F.array_join(units.document_errors(docs), "; ").alias("errors"))


@query(f"""{UNITS_SQL}, n as (select *, case when coalesce(unit_id, '') = '' then '?' else unit_id end nm from u),
k as (select *, row_number() over (partition by o, nm order by pos) seen from n),
e as (select o, pos, 1 i, nm || ': duplicate unit_id' x from k where seen > 1 union all select o, pos, 2, nm || ': empty prompt' from k where trim(coalesce(prompt, '')) = '' union all
select o, pos, 3, nm || ': ' || len(opts) || ' options (expected 4)' from k where len(opts) <> 4 union all select o, pos, 4, nm || ': empty option ''ב''' from k where len(opts) > 1 and trim(second) = '' union all
select o, pos, 5, nm || ': missing correct_option' from k where coalesce(correct, '') = '' union all
select o, pos, 5, nm || ': correct_option ''' || correct || ''' not in (''א'', ''ב'', ''ג'', ''ד'')' from k where correct = 'ז' union all
select o, pos, 6, nm || ': replacement char in text' from k where len(list_filter({_TEXTS}, lambda x: contains(x, '�'))) > 0)
select d.o, concat_ws('; ', case when coalesce(c, 0) <> 4 then 'expected 4 questions, found ' || coalesce(c, 0) end, x) errors, coalesce(f, 0) n_first from d left join (select o, count(*) c from u group by o) a on d.o = a.o
left join (select o, string_agg(x, '; ' order by pos, i) x, least(3, count(*)) f from e group by o) b on d.o = b.o""")
def validate_quiz(spark, d):
    errors = units.quiz_errors(4)
    own = units.first_few(units.quiz_errors(None))
    return quizzes(spark, d).select("o", F.array_join(errors, "; ").alias("errors"), F.size(own).cast("long").alias("n_first"))


@query(f"""{UNITS_SQL} select o, pos, case when kind in (4, 5) then h else prompt end prompt, len(opts) n_options from u""")
def sanitized(spark, d):
    rows = units.exploded_units(units.sanitized(quizzes(spark, d)).withColumn("questionnaire_id", F.col("o")))
    size = F.coalesce(F.size("unit.options"), F.lit(0))
    return rows.select(F.col("doc_id").alias("o"), F.col("pos").cast("long").alias("pos"), "unit.prompt", size.cast("long").alias("n_options"))


@query(f"""{UNITS_SQL} select id, track, stage, civil year_civil, cast(null as varchar) year_hebrew, coalesce(n, 0) question_count, 'quizzes/' || lpad(cast(d.o as varchar), 12, '0') || '.json' json_path, quality extraction_quality,
coalesce(has_key, false) has_answer_key from d left join (select o, count(*) n from u group by o) g on d.o = g.o""")
def manifest(spark, d):
    return units.manifest(quizzes(spark, d)).withColumn("question_count", F.col("question_count").cast("long"))


_QUALITY = "case when coalesce(n, 0) = 0 or coalesce(keyed, 0) = 0 then 'manual_review_needed' when keyed < n then 'partial' else 'clean' end"
_KEYED = "(select o, count(*) n, count(*) filter (where coalesce(correct, '') <> '') keyed from u group by o) g"


@query(f"""{UNITS_SQL}, k as (select d.*, coalesce(n, 0) n, keyed, try_cast(nullif(regexp_extract(id, '(20[0-9]{{2}})', 1), '') as int) told from d left join {_KEYED} on d.o = g.o)
select o, case when id like 'mehozi%' then 'mamlachti_dati' else track end track, case when id like 'mehozi%' then 'district' when id like 'artzi%' then 'national' else stage end stage,
coalesce(civil, told) year_civil, case when quality = 'unreadable' then quality else {_QUALITY} end extraction_quality, coalesce(civil is null and told between 2008 and 2026, false) named from k""")
def reclassified(spark, d):
    out = units.reclassified(quizzes(spark, d))
    return out.select("o", "metadata.track", "metadata.stage", F.col("metadata.contest_year_civil").alias("year_civil"), "import_provenance.extraction_quality", F.col("metadata.contest_year_hebrew").isNotNull().alias("named"))


@query(ORACLES["reclassified"])
def reclassified_stored(spark, d):
    """The same over a keyed store, in place: documents that change replace the old ones."""
    to = scratch(spark, "documents")
    store.upsert(quizzes(spark, d), to, "o", buckets=8)
    processing.reclassify(spark, to, key="o")
    out = store.read(spark, to)
    return out.select("o", "metadata.track", "metadata.stage", F.col("metadata.contest_year_civil").alias("year_civil"), "import_provenance.extraction_quality", F.col("metadata.contest_year_hebrew").isNotNull().alias("named"))


@query(f"""{UNITS_SQL} select track, {_QUALITY} extraction_quality, count(*) n, cast(sum(coalesce(n, 0)) as bigint) questions from d left join {_KEYED} on d.o = g.o group by all""")
def quality_rollup(spark, d):
    all_ = units.units_of(F.col("sections"))
    keyed = F.size(F.filter(all_, units.has_correct_answer))
    docs = quizzes(spark, d).select("metadata.track", F.size(all_).alias("q"), units.quality(F.size(all_), keyed).alias("extraction_quality"))
    return docs.groupBy("track", "extraction_quality").agg(F.count("*").alias("n"), F.sum("q").alias("questions"))


@query(f"""{UNITS_SQL}, g as (select o, count(*) n, count(*) filter (where coalesce(correct, '') <> '') keyed, string_agg(display, ', ' order by pos) filter (where correct is null) missing,
count(*) filter (where contains(coalesce(narrative, ''), '�')) lost from u group by o)
select d.o, nullif(concat_ws('; ', case when coalesce(n, 0) = 0 then 'no question units parsed' when keyed = 0 then 'no answer key found (questions only)' when missing is not null then 'missing answers for: ' || missing end,
case when lost > 0 then 'some narrative verse text could not be enriched; best-effort retained' end), '') notes from d left join g on d.o = g.o""")
def quality_notes(spark, d):
    return quizzes(spark, d).select("o", units.quality_notes(units.units_of(F.col("sections"))).alias("notes"))


@query(f"""{UNITS_SQL}, f as (select o, sec, slot, '.narrative_context' field, narrative x from u union all select o, sec, slot, '.prompt', prompt from u union all select o, sec, slot, '.acceptable_answers[0].answer_text', answer from u union all
select o, sec, slot, '.options[' || (i - 1) || '].text', opts[i].text from u, unnest(range(1, 5)) r(i) where i <= len(opts))
select o, '.sections[' || sec || '].question_units[' || slot || ']' || field path, substr(x, 1, 60) snippet from f where {_BAD}""")
def audit(spark, d):
    return units.audit(quizzes(spark, d), F.struct("sections"), "o")


@query("""select 'olami_mmd20' || lpad(cast(n_nationkey as varchar), 2, '0') questionnaire_id, 'world' stage, 'mamlachti_dati' track, 2000 + n_nationkey year_civil, case when n_nationkey between 8 and 26 then true else false end named,
'unreadable' extraction_quality, 'image ' || n_name extraction_notes, 0::bigint n_sections from nation""")
def stub(spark, d):
    ids = t(spark, d, "nation").select(F.concat(F.lit("olami_mmd20"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("base"), F.lit("u").alias("url"), "n_name")
    s = units.stub(ids, "unreadable", F.concat(F.lit("image "), "n_name"), "2026-01-01")
    return s.select(
        "questionnaire_id", "metadata.stage", "metadata.track", F.col("metadata.contest_year_civil").alias("year_civil"), F.col("metadata.contest_year_hebrew").isNotNull().alias("named"),
        "import_provenance.extraction_quality", "import_provenance.extraction_notes", F.size("sections").cast("long").alias("n_sections"),
    )


@query(f"""{UNITS_SQL}, r as (select o, pos, prompt, opts, h, case when pos % 4 = 0 then null when pos % 4 = 1 then '�' || h else h || ' new' end p, pos % 5 <> 0 there, case when pos % 3 = 0 then 3 else 4 end k from u where n_options is not null)
select o, pos, case when there and p is not null and not contains(p, '�') then p else prompt end prompt,
case when there and k = 4 and len(opts) = 4 then 'new' else 'old' end options,
case when not there then 'no vision data for this question' else concat_ws('; ', case when contains(p, '�') then 'vision prompt rejected (unclean text)' end,
case when not (k = 4 and len(opts) = 4) then 'vision option shape mismatch; kept baseline' else 'vision option ד rejected' end) end warnings from r""")
def merge_baseline(spark, d):
    """Units of the documents and a second reading of four in five of them, whose last option is unclean."""
    rows = units.exploded_units(quizzes(spark, d).withColumn("questionnaire_id", F.col("o"))).where("unit.options is not null")
    mine = rows.select("doc_id", F.col("pos").cast("string").alias("display_number"), "unit.prompt", "unit.options")
    new = F.transform("unit.options", lambda o: o.withField("text", F.when(o["key"] == "ד", F.lit("�")).otherwise(F.lit("new"))))
    h = F.col("unit.format_confidence_note")
    p = F.when(F.col("pos") % 4 == 0, None).when(F.col("pos") % 4 == 1, F.concat(F.lit("�"), h)).otherwise(F.concat(h, F.lit(" new")))
    read = rows.where("pos % 5 <> 0").select("doc_id", F.col("pos").cast("string").alias("display_number"), p.alias("prompt"), F.slice(new, F.lit(1), F.when(F.col("pos") % 3 == 0, 3).otherwise(4)).alias("options"))
    out = matching.merged_review(mine, read)
    return out.select(
        F.col("doc_id").alias("o"), F.col("display_number").cast("long").alias("pos"), "prompt", F.when(F.get("options", F.lit(0))["text"] == "new", "new").otherwise("old").alias("options"),
        F.array_join("warnings", "; ").alias("warnings"),
    )


@query("""with w as (select p_partkey, p_brand, p_size, i, string_split(p_name, ' ')[i] word from part, unnest(range(1, 3)) r(i) where i <= len(string_split(p_name, ' '))),
e as (select *, (p_partkey + i) % 3 = 0 bold, (p_partkey + i) % 4 = 0 under from w)
select p_partkey doc, max(reverse(p_name)) line, string_agg(reverse(word) || case when bold then 'b' else '' end || case when under then 'u' else '' end, ',' order by i) filter (where bold or under) spans
from e join (select p_partkey, p_name from part) using (p_partkey) group by all having count(*) filter (where bold or under) > 0""")
def emphasis_detected(spark, d):
    """Names drawn from right to left, a page each, some words in a bold font and some over a thin rule."""
    chars, shapes = _drawn(t(spark, d, "part"))
    found = emphasis.detected(chars, shapes)
    flags = lambda s: F.concat(s["text"], F.when(s["bold"], "b").otherwise(""), F.when(s["underline"], "u").otherwise(""))
    return found.select(F.col("doc_id").alias("doc"), "line", F.array_join(F.transform("spans", flags), ",").alias("spans"))


def _drawn(part):
    """Characters of each part's name, six points each, and rules under the words with (key + word) % 4 = 0; a thick shape lies under all."""
    chars = part.select("p_partkey", F.posexplode(F.split("p_name", "")).alias("i", "text"), "p_name").where("text <> ''")
    word = F.size(F.split(F.substring(F.col("p_name"), F.lit(1), F.col("i") + 1), " "))
    rows = chars.withColumn("w", F.when(F.col("text") == " ", 0).otherwise(word)).withColumn("top", F.lit(100.0) + F.col("i") % 3)
    c = rows.select(
        F.col("p_partkey").alias("doc_id"), F.lit(0).alias("page_no"), F.col("i").alias("char_no"), "text", (F.col("i") * 6.0).alias("x0"), (F.col("i") * 6.0 + 6).alias("x1"), "top", (F.col("top") + 10).alias("bottom"),
        F.when((F.col("p_partkey") + F.col("w")) % 3 == 0, "Some-BoldMT").otherwise("Some").alias("fontname"),
    )
    under = rows.where("w > 0").where((F.col("p_partkey") + F.col("w")) % 4 == 0).groupBy("p_partkey", "w").agg(F.min("i").alias("a"), F.max("i").alias("b"))
    thin = under.select(F.col("p_partkey").alias("doc_id"), F.lit(0).alias("page_no"), (F.col("a") * 6.0 + 1.5).alias("x0"), (F.col("b") * 6.0 + 4.5).alias("x1"), F.lit(111.0).alias("top"), F.lit(112.0).alias("bottom"))
    thick = part.select(F.col("p_partkey").alias("doc_id"), F.lit(0).alias("page_no"), F.lit(0.0).alias("x0"), F.lit(400.0).alias("x1"), F.lit(111.0).alias("top"), F.lit(120.0).alias("bottom"))
    return c, thin.unionAll(thick)


@query("""select p_partkey doc, 0 page_no, reverse(p_name) || chr(10) || reverse(p_type) as "text" from part""")
def page_texts(spark, d):
    """Two lines of each part's page, and a page number at its foot that goes."""
    part = t(spark, d, "part").select(F.col("p_partkey").alias("doc_id"), F.lit(0).alias("page_no"), "p_name", "p_type", (F.col("p_size") + 1).cast("string").alias("n"))
    chars = None
    for text, top in (("p_name", 100.0), ("p_type", 200.0), ("n", 960.0)):
        c = part.select("doc_id", "page_no", F.posexplode(F.split(text, "")).alias("i", "text")).where("text <> ''")
        c = c.select("doc_id", "page_no", (F.col("i") + int(top) * 1000).alias("char_no"), "text", (F.col("i") * 6.0).alias("x0"), (F.col("i") * 6.0 + 6).alias("x1"), F.lit(top).alias("top"), F.lit(top + 10).alias("bottom"), F.lit("f").alias("fontname"))
        chars = c if chars is None else chars.unionAll(c)
    words = part.select("doc_id", "page_no", F.col("n").alias("text"), F.lit(0.0).alias("x0"), F.lit(50.0).alias("x1"), F.lit(960.0).alias("top"), F.lit(970.0).alias("bottom"))
    middle = part.select("doc_id", "page_no", F.lit("12").alias("text"), F.lit(0.0).alias("x0"), F.lit(500.0).alias("x1"), F.lit(190.0).alias("top"), F.lit(215.0).alias("bottom"))
    pages = part.select("doc_id", "page_no", F.lit(1000.0).alias("height"))
    return emphasis.page_texts(chars, words.unionAll(middle), pages).withColumnRenamed("doc_id", "doc")


_FIRST = "string_split(h, ' ')[1]"


@query(f"""{UNITS_SQL}, f as (select *, o % 3 = 0 and h = first_value(h) over (partition by o order by pos) near from u)
select o, pos, case when near and (kind = 2 or kind > 5) then '<b>' || {_FIRST} || '</b>' || substr(prompt, length({_FIRST}) + 1) else prompt end prompt,
case when near and narrative <> '' then '<b>' || {_FIRST} || '</b>' || substr(narrative, length({_FIRST}) + 1) else narrative end narrative, array_to_string(list_transform(opts, lambda x: x.text), '/') options from f""")
def emphasized(spark, d):
    """A line of each third document, its first unit's name, has its first word in bold: prompts and narratives take it on, options don't."""
    docs = quizzes(spark, d).withColumn("questionnaire_id", F.col("o"))
    first = units.exploded_units(docs).where("pos = 0 and doc_id % 3 = 0").withColumn("h", F.col("unit.format_confidence_note"))
    lines = first.select(
        "doc_id", F.lit(0).alias("page_no"), F.lit(0).alias("line_no"), F.col("h").alias("line"),
        F.array(F.struct(F.split("h", " ")[0].alias("text"), F.lit(True).alias("bold"), F.lit(False).alias("underline"))).alias("spans"),
    )
    rows = units.exploded_units(emphasis.emphasized(docs, lines))
    options = F.array_join(F.transform(F.coalesce("unit.options", F.array().cast("array<struct<key:string,text:string>>")), lambda x: x["text"]), "/")
    return rows.select(F.col("doc_id").alias("o"), F.col("pos").cast("long").alias("pos"), "unit.prompt", F.col("unit.narrative_context").alias("narrative"), options.alias("options"))


_BOOKLET = f"""select p_partkey, {hebrew('p_name')} h, p_size, p_size % 4 + 1 clues from part"""


def _booklet_pages(part):
    """A staged booklet for each part: regulations, a poem, a crossword of one to four clues, some without an answer, and a pair."""
    p = part.selectExpr("p_partkey", f"{hebrew('p_name')} as h", "p_size", "p_size % 4 + 1 as clues")
    rules = F.concat(F.lit("תקנון\nב-"), (F.col("p_size") + 1).cast("string"), F.lit(" נקודות\nלרשותך "), (F.col("p_size") + 40).cast("string"), F.lit(" שניות"))

    def clue(i):
        said = F.when((F.col("p_partkey") + i) % 3 != 0, F.col("h")).otherwise("")
        return F.concat(i.cast("string"), F.lit(". (מאונך) "), F.col("h"), F.lit(" ("), i.cast("string"), F.lit(")\nהתשובה: "), said)

    poem = F.concat(F.lit("שלב א: בעקבות קטעי שירה\nממלכתי:\nשאלה 1\n"), "h", F.lit("\nא. "), "h", F.lit("\nתשובות:\nא. "), "h", F.lit("\n(שמות א, ב)"))
    words = F.concat(F.lit("שלב ב: תשבצים\nתשבץ 1:\n"), F.array_join(F.transform(F.sequence(F.lit(1), F.col("clues")), clue), "\n"))
    pair = F.concat(F.lit("שלב ג: ראש בראש\nצמד 1: "), "h", F.lit("\n1. "), "h", F.lit("\nהתשובה: "), "h", F.lit(" (יתקבל גם: "), "h", F.lit(" / עוד)"))
    return p, F.array(rules, F.concat_ws("\n", poem, words), pair)


@query(f"""with b as ({_BOOKLET}), n as (select *, (select count(*) from (select unnest(range(1, clues + 1)) i) where (p_partkey + i) % 3 <> 0) got from b)
select p_partkey doc, 'stage_א_mamlachti,stage_ב_all,stage_ג_all' section_ids, 'live-rounds,crossword,head-to-head' subtypes, 'שלב א - בעקבות קטעי שירה (ממלכתי)' title, p_size + 1 points, p_size + 40 "seconds",
cast(clues + 2 as bigint) subs, h first_clue, '1' first_length, case when (p_partkey + 1) % 3 <> 0 then h else '' end first_answer, h || ' / עוד' pair_also, 'שמות' book, 3 n_stages,
case when (got + 2) / (clues + 2) < 0.6 then 'partial' else 'clean' end quality, concat_ws('; ', case when (got + 2) / (clues + 2) < 0.6 then 'only ' || got + 2 || '/' || clues + 2 || ' sub-questions have an answer' end,
'public/oral format: 3 sections, 3 units, 3 stages') notes, 'mamlachti' track, 'national' stage from n""")
def staged_booklets(spark, d):
    p, pages = _booklet_pages(t(spark, d, "part"))
    rows = p.select(F.col("p_partkey").cast("string").alias("doc_id"), F.posexplode(pages).alias("page_no", "text"))
    s = F.col("sections")
    docs = booklets.staged_documents(rows, "2026-01-01")
    all_ = units.units_of(s)
    subs = lambda i: all_[i]["subquestions"]
    texts = lambda a: F.transform(a, lambda x: x["answer_text"])
    clue = subs(1)[0]
    return docs.select(
        F.col("questionnaire_id").cast("long").alias("doc"), F.array_join(F.transform(s, lambda x: x["section_id"]), ",").alias("section_ids"), F.array_join(F.transform(s, lambda x: x["stage_subtype"]), ",").alias("subtypes"),
        s[0]["section_title"].alias("title"), s[0]["live_stage_rules"]["points_per_correct"].alias("points"), s[0]["live_stage_rules"]["time_limit_seconds"].alias("seconds"),
        F.size(F.flatten(F.transform(all_, lambda u: u["subquestions"]))).cast("long").alias("subs"), clue["prompt"].alias("first_clue"), clue["answer_length"].alias("first_length"),
        F.array_join(texts(clue["acceptable_answers"]), " / ").alias("first_answer"), F.array_join(F.slice(texts(subs(2)[0]["acceptable_answers"]), 2, 9), " / ").alias("pair_also"),
        all_[0]["primary_sources"][0]["book"].alias("book"), F.size(units.stage_letters(s)).alias("n_stages"), "import_provenance.extraction_quality", F.col("import_provenance.extraction_notes").alias("notes"),
        F.col("metadata.track").alias("track"), F.col("metadata.stage").alias("stage"),
    ).withColumnRenamed("extraction_quality", "quality")


@query(f"""{UNITS_SQL} select u.o doc, 'q' || case when pos < 9 then '0' else '' end || pos + 1 unit_id, h prompt, 4::bigint n_options, case when correct in ('א', 'ב') then correct end correct,
case when correct in ('א', 'ב') then h || ' ' || correct end answer, case when correct in ('א', 'ב') then 'שמות א:' || case when display > '0' then substr('אבגדהוז', cast(display as int), 1) end end source,
case when keyed = 0 then 'manual_review_needed' when keyed < n then 'partial' else 'clean' end quality, case when keyed > 0 then 'same_document' else 'none' end location, 45 "minutes", h0 authors
from u join (select o, count(*) n, count(*) filter (where correct in ('א', 'ב')) keyed, arg_min(h, pos) h0 from u group by o) g on u.o = g.o""")
def questionnaires(spark, d):
    """Pages of a cover, of numbered questions with four options and of an answer key, made from each order's lines."""
    docs = packed_lines(spark, d).select("o", quiz_columns("h", "correct", "display").alias("quiz"))

    def asked(u, i):
        return F.concat((i + 1).cast("string"), F.lit(". "), u["h"], *[F.concat(F.lit(f"\n{k}. "), u["h"], F.lit(f" {k}")) for k in "אבגד"])

    def key(u, i):
        return F.when(u["correct"].isin("א", "ב"), F.concat(u["correct"], F.lit(". "), u["h"], F.lit("\n"), (i + 1).cast("string"), F.lit(" שמות א, "), T.numeral(u["display"].cast("int"))))

    body, keys = F.array_join(F.transform("quiz", asked), "\n"), F.array_join(F.transform("quiz", key), "\n")
    cover = F.concat(F.lit("זמן הבחינה: 45 דקות\nמחברי השאלות: "), F.col("quiz")[0]["h"])
    pages = docs.select(F.col("o").cast("string").alias("doc_id"), F.posexplode(F.array(cover, body, F.concat(F.lit("תשובון\n"), keys))).alias("page_no", "text"))
    out = booklets.questionnaires(pages, "2026-01-01")
    rows = out.select("questionnaire_id", "metadata", "import_provenance", "answer_key_location", F.explode_outer(F.col("sections")[0]["question_units"]).alias("u")).where("u is not null")
    source = F.get("u.primary_sources", F.lit(0))
    return rows.select(
        F.col("questionnaire_id").cast("long").alias("doc"), "u.unit_id", "u.prompt", F.size("u.options").cast("long").alias("n_options"), F.col("u.correct_option").alias("correct"),
        F.get("u.acceptable_answers", F.lit(0))["answer_text"].alias("answer"), F.concat(source["book"], F.lit(" "), source["chapter"], F.lit(":"), source["verse"]).alias("source"),
        F.col("import_provenance.extraction_quality").alias("quality"), F.col("answer_key_location").alias("location"), F.col("metadata.time_limit_minutes").alias("minutes"),
        F.array_join("metadata.credits.question_authors", ",").alias("authors"),
    )


@query(f"""with b as ({_BOOKLET}), n as (select *, (select count(*) from (select unnest(range(1, clues + 1)) i) where (p_partkey + i) % 3 <> 0) got from b)
select cast(p_partkey as varchar) id, case when p_partkey % 8 = 7 then 'skipped_existing' when p_partkey % 8 = 6 then 'fetch_failed' else 'success' end status,
case p_partkey % 8 when 0 then case when (got + 2) / (clues + 2) < 0.6 then 'partial' else 'clean' end when 1 then 'clean' when 2 then 'unreadable' when 3 then 'unreadable' when 4 then 'unreadable' when 5 then 'manual_review_needed' end extraction_quality,
cast(case p_partkey % 8 when 0 then 3 when 1 then 1 when 5 then 1 else 0 end as bigint) question_count, case when p_partkey % 8 < 6 then 0::bigint end suspicious_hebrew,
case p_partkey % 8 when 2 then 'image-based PDF -- text layer empty' when 3 then 'binary .doc -- could not extract text' when 4 then 'extraction error: boom' when 5 then 'no answer key found (questions only)' end note from n""")
def processed(spark, d):
    """Files of every kind: staged booklets, questionnaires, empty and broken files, some done before, some not fetched.

    Ids are the keys in letters, as a key like 12001 would tell the operator a year.
    """
    p, pages = _booklet_pages(t(spark, d, "part"))
    k = F.col("p_partkey") % 8
    question = F.concat(F.lit("1. "), "h", *[F.concat(F.lit(f"\n{x}. "), F.col("h")) for x in "אבגד"], F.lit("\nשורה ארוכה של אותיות שאין בה שום שאלה ושום תשובה"))
    key = F.concat(F.lit("תשובון\nא. "), "h", F.lit("\n1 שמות א, ב"))
    cover = F.lit("דף השער")
    texts = F.when(k == 0, pages).when(k == 1, F.array(cover, question, key)).when(k == 5, F.array(cover, question)).when(k != 4, F.array(F.lit("")))
    kind = F.when(k == 3, "doc").otherwise("pdf")
    rows = p.select(F.translate(F.col("p_partkey").cast("string"), "0123456789", "abcdefghij").alias("doc_id"), kind.alias("kind"), texts.alias("pages"), F.when(k == 4, "boom").alias("error"), F.lit(0).alias("second_letters"), k.alias("k"))
    entries, done = rows.select(F.col("doc_id").alias("base")), rows.where("k = 7").select(F.col("doc_id").alias("base"))
    to = f"{scratch(spark, 'parsed')}/rows"
    processing.parsed(rows.where("k < 6").drop("k"), "2026-01-01").write.parquet(to)
    docs = spark.read.parquet(to)
    out = processing.results(entries, docs, done)
    note = docs.select(F.col("questionnaire_id").alias("id"), F.col("import_provenance.extraction_notes").alias("note"))
    j = out.join(note, "id", "left").withColumn("note", F.when(~F.coalesce(F.col("note"), F.lit("")).contains("public/oral"), F.col("note")))
    return j.withColumn("question_count", F.col("question_count").cast("long")).withColumn("id", F.translate("id", "abcdefghij", "0123456789"))


@query(f"""{UNITS_SQL}, g as (select id, unit_id, last(prompt order by pos) p, last(correct order by pos) c, coalesce(last(n_sources order by pos), 0) s, count(*) n from u join d on u.o = d.o where id is not null and unit_id <> '' group by all),
x as (select id || '/' || unit_id k, p, c, s from g), y as (select id || '/' || unit_id k, case when unit_id = 'q02' then 0 else s end s, case when n > 1 then p || '!' else '<u>' || p || '</u> ' end p, case when c = 'ב' then null else c end c from g where unit_id <> 'q03'),
f as (select coalesce(x.k, y.k) k, case when y.k is null then 'missing' when x.k is null then 'extra' end issue, x.k is not null and y.k is not null and trim(regexp_replace(coalesce(x.p, ''), '</?[a-z]>', '', 'g')) <> trim(regexp_replace(coalesce(y.p, ''), '</?[a-z]>', '', 'g')) prompt_differs,
x.k is not null and y.k is not null and x.c is distinct from y.c correct_differs, x.k is not null and y.k is not null and x.s <> y.s sources_differs from x full join y on x.k = y.k)
select (select count(*) from x join y using (k)) questions_compared, count(*) questions_with_diffs, count(*) filter (where issue = 'missing') missing, count(*) filter (where prompt_differs) prompts, count(*) filter (where correct_differs) corrects, count(*) filter (where sources_differs) sources
from f where issue is not null or prompt_differs or correct_differs or sources_differs""")
def evaluated(spark, d):
    """Documents against a changed copy: units that go, prompts that change or only get tags, answers and sources that go; the order of sources doesn't count."""
    rows = units.exploded_units(quizzes(spark, d)).where("doc_id is not null and unit.unit_id <> ''")
    key = F.concat("doc_id", F.lit("/"), F.col("unit.unit_id"))
    mine = rows.select(key.alias("k"), "pos", F.col("unit.prompt").alias("prompt"), F.col("unit.correct_option").alias("correct"), F.col("unit.primary_sources").alias("primary_sources"))
    last = mine.groupBy("k").agg(F.max_by(F.struct("prompt", "correct", "primary_sources"), "pos").alias("x"), F.count("*").alias("n"))
    p = F.when(F.col("n") > 1, F.concat("x.prompt", F.lit("!"))).otherwise(F.concat(F.lit("<u>"), "x.prompt", F.lit("</u> ")))
    copy = last.where("k not like '%/q03'").select("k", F.lit(0).alias("pos"), p.alias("prompt"), F.when(F.col("x.correct") != "ב", F.col("x.correct")).alias("correct"), F.when(~F.col("k").like("%/q02"), F.reverse("x.primary_sources")).alias("primary_sources"))
    fields = {"prompt": T.comparable(F.col("prompt")), "correct": F.col("correct"), "sources": matching.sources_of({"primary_sources": F.col("primary_sources")})}
    both = matching.compared(mine, copy, "k", fields, order="pos")
    found = matching.diff(mine, copy, "k", fields, order="pos")
    counts = found.agg(F.count_if(F.col("issue") == "missing").alias("missing"), F.count_if("prompt_differs").alias("prompts"), F.count_if("correct_differs").alias("corrects"), F.count_if("sources_differs").alias("sources"))
    return both.crossJoin(counts)  # one row each
