from pyspark.sql import functions as F

from quireflow import schema
from quireflow.operators import booklets, emphasis, folds, matching, processing, quotes, segments, units
from quireflow.sources import files, store


def lines_df(spark, text, doc="d"):
    return spark.createDataFrame([(doc, i, x) for i, x in enumerate(text.split("\n"))], "doc_id string, pos int, line string")


def test_question_fold(spark):
    body = ["1. מי היה?", "א. דוד", "ב. שאול", "המלך", "5", "2. מה", "קרה?", "א. 3", "7. לא שאלה", "ב. 12", "3. סוף", "____", ""]
    df = spark.createDataFrame([(body,)], "lines array<string>")
    got = df.select(folds.questions(F.col("lines")).alias("u")).first()["u"]
    assert [(u["number"], u["prompt"], [tuple(o) for o in u["options"]]) for u in got] == [
        (1, "מי היה?", [("א", "דוד"), ("ב", "שאול המלך")]),
        (2, "מה קרה?", [("א", "3 7. לא שאלה"), ("ב", "12")]),
        (3, "סוף", []),
    ]


def test_answer_key_last_wins(spark):
    got = folds.answer_key(lines_df(spark, "תשובון\nא. דוד\n1 שמות יד, כא\nב. שאול\n2\nבראשית ה, ו\nג. משה\n1 שמות טו, א")).collect()
    assert {(r["qnum"], r["correct_option"], r["answer_text"], r["refs"][0]["book"], r["refs"][0]["verse"]) for r in got} == {(1, "ג", "משה", "שמות", "א"), (2, "ב", "שאול", "בראשית", "ו")}


def test_answer_table(spark):
    cells = [
        ("d", 0, 0, 0, "מקור"), ("d", 0, 0, 1, "תשובה"), ("d", 0, 0, 2, "שאלה"),
        ("d", 0, 1, 0, "שמות יד, כא"), ("d", 0, 1, 1, "ג"), ("d", 0, 1, 2, "1"),
        ("d", 1, 0, 0, "בראשית ה, ו"), ("d", 1, 0, 1, "ב. דוד"), ("d", 1, 0, 2, "2"),
        ("d", 1, 1, 0, "x"), ("d", 1, 1, 1, "א"), ("d", 1, 1, 2, "0"),
    ]
    got = folds.answer_table(spark.createDataFrame(cells, "doc_id string, table_no int, row_no int, col_no int, text string")).collect()
    assert {(r["qnum"], r["correct_option"], r["refs"][0]["book"]) for r in got} == {(1, "ג", "שמות"), (2, "ב", "בראשית")}


UNIT = {
    "unit_id": "q01", "display_number": "1", "narrative_context": None, "prompt": "מי?", "question_type": "multiple_choice", "answer_style": "single_correct",
    "options": [{"key": k, "text": "ת" + k} for k in "אבגד"], "correct_option": "ב", "subquestions": None, "primary_sources": [], "scoring": {"points": None},
    "acceptable_answers": [], "media_attachments": None, "localizations": None, "format_confidence_note": None,
}


def document(spark, units_, quality="clean", name="mehozi_mm2024"):
    metadata = {"contest_year_civil": None, "contest_year_hebrew": None, "track": None, "stage": None, "sitting": None, "age_group": None, "annual_theme": None, "credits": None,
                "syllabus": [], "time_limit_minutes": None, "instructions_text": None, "source_text_edition": None, "scoring_summary": None}
    section = {"section_id": "main", "section_title": None, "section_epigraph": None, "stage_subtype": None, "track": None, "live_stage_rules": None, "question_units": units_}
    row = {"questionnaire_id": name, "source_url": None, "metadata": metadata, "sections": [section], "answer_key_present": True, "answer_key_location": "none", "answer_key_source": None,
           "import_provenance": {"fetched_from": None, "fetch_date": "2026-01-01", "extraction_quality": quality, "extraction_notes": None}}
    return spark.createDataFrame([row], schema.DOCUMENT).withColumn("json_path", F.lit(f"{name}.json"))


def test_units_and_reports(spark):
    docs = document(spark, [UNIT, UNIT | {"prompt": "אביגיל 5", "options": UNIT["options"][:3], "correct_option": None}])
    assert units.exploded_units(docs).count() == 2
    s = units.stats(docs).first()
    assert (s["questions_detected"], s["with_four_answers"], s["with_correct_answer"], s["page_furniture_contamination"]) == (2, 1, 1, 1)
    errors = docs.select(units.quiz_errors(2).alias("e")).first()["e"]
    assert errors == ["q01: duplicate unit_id", "q01: 3 options (expected 4)", "q01: missing correct_option"]
    assert docs.select(units.document_errors(docs).alias("e")).first()["e"] == []
    r = units.reclassified(docs).first()
    assert (r["metadata"]["track"], r["metadata"]["stage"], r["metadata"]["contest_year_civil"], r["import_provenance"]["extraction_quality"]) == ("mamlachti", "district", 2024, "partial")
    assert units.manifest(docs).first()["question_count"] == 2
    empty = document(spark, [], "unreadable")
    assert empty.select(units.document_errors(empty).alias("e")).first()["e"] == []
    assert units.reclassified(empty).first()["import_provenance"]["extraction_quality"] == "unreadable"


def test_audit_and_stub(spark):
    docs = document(spark, [UNIT | {"prompt": "א�ב"}])
    found = units.audit(docs, F.struct(*docs.columns), "questionnaire_id").collect()
    assert [r["path"] for r in found] == [".sections[0].question_units[0].prompt"]
    stub = units.stub(spark.createDataFrame([("OLAMI_PUB_MMD", "u")], "base string, url string"), "unreadable", "image", "2026-01-01").first()
    assert stub["metadata"]["stage"] == "world" and stub["sections"] == []


def test_sanitized(spark):
    docs = units.sanitized(document(spark, [UNIT | {"prompt": "<b>x"}]))
    assert docs.select(units.units_of(F.col("sections"))[0]["prompt"]).first()[0] == "x"


def test_run_log(spark):
    rows = [("a", "success", 2), ("b", "fetch_failed", None), ("c", "success", 1)]
    assert tuple(units.run_log(spark.createDataFrame(rows, "id string, status string, suspicious_hebrew int")).first()) == (3, 2, 0, 1, 3)


def test_review_merge(spark):
    kind = "doc_id string, display_number string, prompt string, options array<struct<key:string,text:string>>"
    four = [(k, "ישן") for k in "אבגד"]
    units_ = spark.createDataFrame([("d", "1", "p", four), ("d", "2", "p", four), ("d", "3", "p", four)], kind)
    review = spark.createDataFrame([("d", "1", "חדש", [(k, "חדש") for k in "אבגד"]), ("d", "2", "א�", [("א", "x")])], kind)
    got = {r["display_number"]: r for r in matching.merged_review(units_, review).collect()}
    assert got["1"]["prompt"] == "חדש" and got["1"]["options"][3]["text"] == "חדש" and got["1"]["warnings"] == []
    assert got["2"]["prompt"] == "p" and len(got["2"]["warnings"]) == 2
    assert got["3"]["warnings"] == ["no vision data for this question"]


def test_pairing_never_crosses_blocks(spark):
    kind = "id string, core string, block boolean, year int, pos int"
    left = spark.createDataFrame([("q", "mehozi2024", False, 2024, 0)], kind)
    right = spark.createDataFrame([("a", "mehozi2024x", False, None, 0), ("b", "mehozi2024", True, 2024, 1), ("c", "mehozi2023", False, 2023, 2), ("d", "ehozi", False, 2024, 3)], kind)
    assert [(r["right_id"], r["score"], r["place"]) for r in matching.paired(left, right).orderBy("place").collect()] == [("a", 10, 1), ("d", 5, 2)]


def test_guard_rounds_half_to_even(spark):
    rows = spark.createDataFrame([(10, 12), (10, 13), (0, 1), (33, 30), (47, 50), (23, 30)], "n int, q int")
    assert [r[0] for r in rows.select(matching.count_guard(F.col("n"), F.col("q"))).collect()] == [True, False, False, True, True, False]


def test_diff(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "z")], "id string, t string")
    b = spark.createDataFrame([("1", "x"), ("2", "w"), ("4", "z")], "id string, t string")
    assert {(r["id"], r["issue"], r["t_differs"]) for r in matching.diff(a, b, "id", ["t"]).collect()} == {("2", None, True), ("3", "missing", False), ("4", "extra", False)}


def test_contained(spark):
    hays = spark.createDataFrame([(1, "a b c d e f g h"), (2, "x b c d e f y"), (3, "q a b")], "h int, text string")
    needles = spark.createDataFrame([(1, "b c d e f g"), (2, "a b"), (3, "zz"), (4, "c d e f")], "n int, text string")
    got = {(r["n"], r["h"], r["at"]) for r in matching.contained(needles, hays, "n", "h").collect()}
    assert got == {(1, 1, 3), (2, 1, 1), (2, 3, 3), (4, 1, 5), (4, 2, 5)}


def test_geometry(spark):
    words = spark.createDataFrame([("d", 0, 0, 10.0, 30.0, 100.0, 110.0), ("d", 0, 1, 50.0, 60.0, 100.0, 110.0)], "doc_id string, page_no int, word_no int, x0 double, x1 double, top double, bottom double")
    shapes = spark.createDataFrame([("d", 0, 9.0, 31.0, 112.0, 113.0), ("d", 0, 50.0, 60.0, 112.0, 120.0)], "doc_id string, page_no int, x0 double, x1 double, top double, bottom double")
    assert [r["underline"] for r in matching.underlined(words, matching.thin_rules(shapes)).orderBy("word_no").collect()] == [True, False]


def test_sources_zip_short(spark):
    q = "struct<refs:array<struct<book:string,chapter:string,verse:string>>,options:array<struct<key:string,text:string>>>"
    row = spark.createDataFrame([(([("שמות", "א", "ב"), ("שמות", "ג", "ד")], [(k, "t") for k in "אבגד"]),)], f"q {q}")
    got = row.select(matching.unit_sources(F.lit("negative_exclusion"), F.col("q.refs"), F.col("q.options"), F.lit("א")).alias("s")).first()["s"]
    assert [s["scope"] for s in got] == ["answer_option:ב", "answer_option:ג"]


def test_runs_and_carry(spark):
    rows = spark.createDataFrame([("u", i, v) for i, v in enumerate([1, 1, 0, 1, 1, 1, 0, 1, 1, 1])], "k string, i int, v int")
    assert [tuple(r) for r in segments.longest_runs(rows, ("k",), ("i",), F.col("v") == 1).collect()] == [("u", 4, 3)]
    carried = segments.carried_forward(rows, "k", "i", F.when(F.col("v") == 0, F.col("i")), "c").orderBy("i").collect()
    assert [r["c"] for r in carried] == [None, None, 2, 2, 2, 2, 6, 6, 6, 6]


VERSES = [
    (0, "שמות", 14, 20, "וַיָּבֹא בֵּין מַחֲנֵה מִצְרַיִם"), (1, "שמות", 14, 21, "וַיֵּט מֹשֶׁה אֶת יָדוֹ עַל הַיָּם"),
    (2, "שמות", 14, 22, "וַיָּבֹאוּ בְנֵי יִשְׂרָאֵל בְּתוֹךְ הַיָּם"), (3, "ויקרא", 1, 1, "וַיִּקְרָא אֶל מֹשֶׁה"),
]


def test_quotes(spark):
    verses = spark.createDataFrame(VERSES, "idx long, book string, chapter int, verse int, niqqud string")
    q = spark.createDataFrame([("a", "ויט משה את ידו על הים"), ("b", "משפט שלא נמצא בשום מקום"), ("c", "ויבאו בני ישראל")], "quote_id string, quote string")
    got = {r["quote_id"]: r for r in quotes.resolved(q, verses).collect()}
    assert set(got) == {"a", "c"} and (got["a"]["book"], got["a"]["verse"]) == ("שמות", 21)
    assert got["c"]["text"] == VERSES[1][4] + " " + VERSES[2][4]
    rows = spark.createDataFrame([("1", 'מי אמר "וַיֵט משה את ידו" ומתי')], "id string, text string")
    r = quotes.cleaned_inline(rows, verses).first()
    assert r["is_cleaned"] and r["cleaned"] == 'מי אמר "וַיֵּט מֹשֶׁה אֶת יָדוֹ" ומתי'
    refs = spark.createDataFrame([("x", 0, "שמות", "יד", "כא-כב"), ("y", 0, "שמות", "יד", "כא"), ("y", 1, "שמות", "ל", "א")], "id string, pos int, book string, chapter string, verse string")
    texts = {r["id"]: r["text"] for r in quotes.verse_texts(refs, verses).collect()}
    assert texts["x"] == VERSES[1][4] + " " + VERSES[2][4] and texts["y"] is None


BOOKLET = """שלב א: בעקבות קטעי שירה
ממלכתי:
שאלה 1
קטע על המלך
א. מי המלך?
ב. מתי מלך?
תשובות:
א. דוד
ב. אחרי שאול
תתקבל גם התשובה: לפני שלמה
(שמואל ב ה, ד)
ממלכתי-דתי:
שאלה 1
א. מי?
תשובות:
א. משה
שלב ב: תשבצים
תשבץ 1:
1. (מאונך) מלך ישראל (5)
התשובה: שלמה (יתקבל גם: ידידיה)
(מלכים א ב, א)
שלב ג: ראש בראש
צמד 1: מלכים
1. מי בנה?
התשובה: שלמה"""


def test_booklet(spark):
    pages = spark.createDataFrame([("d", 0, "תקנון\nב-5 נקודות\nלרשותך 45 שניות"), ("d", 1, BOOKLET)], "doc_id string, page_no int, text string")
    sections = booklets.staged_sections(pages).first()["sections"]
    assert [s["section_id"] for s in sections] == ["stage_א_mamlachti", "stage_א_mamlachti-dati", "stage_ב_all", "stage_ג_all"]
    assert [s["stage_subtype"] for s in sections] == ["live-rounds", "live-rounds", "crossword", "head-to-head"]
    assert sections[0]["section_title"] == "שלב א - בעקבות קטעי שירה (ממלכתי)"
    assert tuple(sections[0]["live_stage_rules"]) == (5, None, 45)
    poem = sections[0]["question_units"][0]
    assert (poem["unit_id"], poem["narrative_context"], [s["label"] for s in poem["subquestions"]]) == ("q01", "קטע על המלך", ["א", "ב"])
    assert [(a["answer_text"], a["is_primary"]) for a in poem["subquestions"][1]["acceptable_answers"]] == [("אחרי שאול", True), ("לפני שלמה", False)]
    assert poem["primary_sources"][0]["book"] == "שמואל ב"
    clue = sections[2]["question_units"][0]["subquestions"][0]
    assert (clue["prompt"], clue["answer_length"], [a["answer_text"] for a in clue["acceptable_answers"]]) == ("מלך ישראל", "5", ["שלמה", "ידידיה"])
    assert sections[3]["question_units"][0]["display_number"] == "צמד 1: מלכים"


def test_questionnaire(spark):
    pages = [
        ("mehozi_mm2024", 0, "זמן הבחינה: 45\nמחברי השאלות: דן כהן ורון לוי"),
        ("mehozi_mm2024", 1, "1. מי היה?\nא. דוד\nב. שאול\n2. מה?\nא. כן\nב. לא"),
        ("mehozi_mm2024", 2, "תשובון\nב. שאול\n1 שמות יד, כא"),
    ]
    doc = booklets.questionnaires(spark.createDataFrame(pages, "doc_id string, page_no int, text string"), "2026-01-01").first()
    first, second = doc["sections"][0]["question_units"]
    assert (first["correct_option"], first["primary_sources"][0]["book"], first["acceptable_answers"][0]["answer_text"]) == ("ב", "שמות", "שאול")
    assert second["correct_option"] is None and doc["import_provenance"]["extraction_quality"] == "partial"
    assert doc["metadata"]["time_limit_minutes"] == 45 and doc["metadata"]["credits"]["question_authors"] == ["דן כהן", "רון לוי"]
    assert doc["metadata"]["contest_year_hebrew"] == 'תשפ"ד' and doc["answer_key_location"] == "same_document"


def test_files(spark, tmp_path):
    import json
    import zipfile

    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body><w:p><w:r><w:t>one</w:t></w:r></w:p><w:p><w:r><w:t>two</w:t></w:r></w:p></w:body></w:document>")
    (tmp_path / "b.doc").write_bytes(b"\xd0\xcf")
    got = {r["doc_id"]: r["text"] for r in files.read_pages(spark, str(tmp_path)).collect()}
    assert got == {"a": "one\ntwo", "b": ""}
    (tmp_path / "v.jsonl").write_text('{"book":"x","chapter":1,"verse":1,"niqqud":"","text_with_niqqud":"אָב׃"}\n\n', encoding="utf-8")
    assert files.read_verses(spark, str(tmp_path / "v.jsonl")).first()["niqqud"] == "אָב"
    d = tmp_path / "docs"
    d.mkdir()
    (d / "one.json").write_text(json.dumps({"questionnaire_id": "one", "sections": []}, indent=2))
    (d / "manifest.json").write_text("{}")
    assert [r["json_path"] for r in files.read_documents(spark, str(d)).collect()] == ["one.json"]
    page = spark.createDataFrame([(1, '<a href="/files/x_ans.pdf">1</a><a href="http://h/files/y.docx">2</a><a href="/z.pdf">'), (2, '<a href="/files/y.pdf">')], "page_id int, html string")
    links = {r["base"]: r for r in files.discovered(page, base_url="http://b/").collect()}
    assert set(links) == {"x_ans", "y"} and links["x_ans"]["is_answer_key"] and links["x_ans"]["url"] == "http://b/x_ans.pdf" and links["y"]["page"] == 1


def test_contained_repeats_and_nulls(spark):
    """Every needle row meets every hay row that has it, as a nested loop would; nulls and empty needles find nothing."""
    hays = spark.createDataFrame([(1, "one two three four five six seven"), (1, "one two three four five six seven"), (None, "two three"), (3, None), (4, ""), (5, "é" * 70_000 + " two")], "h int, text string")
    needles = spark.createDataFrame([(1, "two three"), (1, "two three"), (None, "two"), (3, "one two three four five six seven"), (4, ""), (5, None), (6, "o")], "n int, text string")
    got = sorted(((r["n"], r["h"], r["at"]) for r in matching.contained(needles, hays, "n", "h").collect()), key=repr)
    want = [(n, h, ht.find(nt) + 1) for n, nt in [tuple(r) for r in needles.collect()] for h, ht in [tuple(r) for r in hays.collect()] if nt and ht and nt in ht]
    assert got == sorted(want, key=repr) and len(got) > 12
    assert sorted(((r["n"], r["h"], r["at"]) for r in matching.contained(needles, hays, "n", "h", most=2).collect()), key=repr) == got  # in several passes
    assert matching.contained(needles.where("false"), hays, "n", "h").count() == matching.contained(needles, hays.where("false"), "n", "h").count() == 0


def test_long_document_is_folded(spark):
    lines = F.transform(F.sequence(F.lit(0), F.lit(29_999)), lambda i: F.when(i % 3 == 0, F.concat((F.floor(i / 3) + 1).cast("string"), F.lit(". q"))).otherwise(F.concat(F.lit("א. o"), i.cast("string"))))
    u = spark.range(1).select(folds.questions(lines).alias("u")).select(F.size("u").alias("n"), F.col("u")[9_999]["options"].alias("o")).first()
    assert u["n"] == 10_000 and [x["text"] for x in u["o"]] == ["o29998", "o29999"]
    rows = spark.createDataFrame([("d", 0, 1_000_000, "last"), ("d", 1, 0, "next"), ("d", 0, 0, None)], "doc_id string, page_no int, line_no int, line string")
    assert folds.lines_of(rows).first()["lines"] == ["", "last", "next"]
    odd = spark.createDataFrame([(None,), ([],), ([None, "1. a", "99999999999999999999. b"],)], "l array<string>").select(folds.questions(F.col("l")).alias("u")).collect()
    assert [None if r["u"] is None else [(x["number"], x["prompt"]) for x in r["u"]] for r in odd] == [None, [], [(1, "a 99999999999999999999. b")]]


def test_review_is_deterministic(spark):
    kind = "doc_id string, display_number string, prompt string, options array<struct<key:string,text:string>>"
    units_ = spark.createDataFrame([("d", "1", "p", None), (None, "1", "p", [])], kind)
    review = spark.createDataFrame([("d", "1", "a", None, 2), ("d", "1", "b", None, 1), ("d", "1", None, None, 0)], kind + ", seq int")
    assert {r["doc_id"]: r["prompt"] for r in matching.merged_review(units_, review).collect()} == {"d": "b", None: "p"}
    assert {r["doc_id"]: r["prompt"] for r in matching.merged_review(units_, review, "seq").collect()} == {"d": "a", None: "p"}


def test_walk(spark):
    deep = "[" * 60 + "1.50" + "]" * 60
    rows = spark.createDataFrame([(1, '{"a":[true,null,{"b":"x"}],"c":1e3}'), (2, None), (3, deep), (4, "{}"), (5, '"t"')], "i int, json string")
    got = {(r["i"], r["path"], r["value"]) for r in units.walk(rows, "i").collect()}
    assert got == {(1, ".a[0]", "true"), (1, ".a[1]", None), (1, ".a[2].b", "x"), (1, ".c", "1e3"), (3, "[0]" * 60, "1.50"), (5, "", "t")}


def test_emphasis_stays_off_options(spark):
    unit = UNIT | {"prompt": "מי לא היה", "options": [{"key": k, "text": "מי לא היה"} for k in "אבגד"]}
    docs = document(spark, [unit, unit | {"prompt": None}]).unionAll(document(spark, [unit], name="other")).unionAll(document(spark, None, name="none"))
    docs = docs.unionAll(docs.where("questionnaire_id = 'other'"))
    lines = spark.createDataFrame([("mehozi_mm2024", 0, 0, "מי לא היה", [("לא", True, True)])], "doc_id string, page_no int, line_no int, line string, spans array<struct<text:string,bold:boolean,underline:boolean>>")
    out = emphasis.emphasized(docs, lines).collect()
    got = [(r["questionnaire_id"], [(u["prompt"], {o["text"] for o in u["options"]}) for s in r["sections"] for u in s["question_units"] or []]) for r in out]
    plain = ("מי לא היה", {"מי לא היה"})
    assert sorted(got) == sorted([("mehozi_mm2024", [("מי <b><u>לא</u></b> היה", {"מי לא היה"}), (None, {"מי לא היה"})]), ("other", [plain]), ("other", [plain]), ("none", [])])


def test_lines_are_anchored_to_their_first_character(spark):
    rows = [("d", 0, i, c, 10.0 * i, 10.0 * i + 9, top, top + 10, "Arial-BoldMT" if c in "ab" else None) for i, (c, top) in enumerate(zip("abcd", [100.0, 102.0, 104.0, 106.0]))]
    rows += [("d", 0, 9, None, 1.0, 2.0, 1.0, 2.0, "f"), ("d", 0, 10, " ", 20.0, 21.0, 100.0, 110.0, "f")]
    chars = spark.createDataFrame(rows, "doc_id string, page_no int, char_no int, text string, x0 double, x1 double, top double, bottom double, fontname string")
    lines = emphasis.lines_of_chars(chars)
    assert sorted((r["text"], r["line_no"]) for r in lines.collect()) == [(" ", 0), ("a", 0), ("b", 0), ("c", 1), ("d", 1)]
    words = {r["text"]: r["bold"] for r in emphasis.words_of_chars(lines).collect()}
    assert words == {"ba": True, "dc": False}
    assert emphasis.detected(chars.where("false"), chars.select("doc_id", "page_no", "x0", "x1", "top", "bottom").where("false")).count() == 0


def test_process_files(spark, tmp_path):
    """A batch of files: parsed, unreadable and broken ones; a second run skips what is there."""
    import zipfile

    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    (tmp_path / "in").mkdir()
    body = "".join(f"<w:p><w:r><w:t>{x}</w:t></w:r></w:p>" for x in ["שער", "עוד שורה של שער עם הרבה אותיות כדי שיהיה מה לקרוא בקובץ הזה"])
    with zipfile.ZipFile(tmp_path / "in" / "mehozi_mm2024.docx", "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{body}</w:body></w:document>")
    (tmp_path / "in" / "old.doc").write_bytes(b"\xd0\xcf")
    (tmp_path / "in" / "scan.pdf").write_bytes(b"x")
    (tmp_path / "in" / "broken.pdf").write_bytes(b"y")

    def pdf(content):
        if content == b"y":
            raise ValueError("no pdf")
        return [""]

    to = str(tmp_path / "out")
    first = {r["id"]: r for r in processing.process(spark, str(tmp_path / "in"), to, "2026-01-01", readers={"pdf": pdf}, second={"pdf": lambda c: ["ab"]}).collect()}
    assert {k: r["status"] for k, r in first.items()} == dict.fromkeys(["mehozi_mm2024", "old", "scan", "broken"], "success")
    assert {k: r["extraction_quality"] for k, r in first.items()} == {"mehozi_mm2024": "manual_review_needed", "old": "unreadable", "scan": "unreadable", "broken": "unreadable"}
    docs = store.read(spark, to)
    notes = {r["questionnaire_id"]: r["n"] for r in docs.select("questionnaire_id", F.col("import_provenance.extraction_notes").alias("n")).collect()}
    assert notes["broken"] == "extraction error: no pdf" and notes["scan"] == "image-based PDF -- text layer empty"
    assert notes["mehozi_mm2024"] == "no question units parsed; validation: no question units"
    (tmp_path / "in" / "new.doc").write_bytes(b"z")
    again = {r["id"]: r["status"] for r in processing.process(spark, str(tmp_path / "in"), to, "2026-01-01", readers={"pdf": pdf}).collect()}
    assert again == dict.fromkeys(["mehozi_mm2024", "old", "scan", "broken"], "skipped_existing") | {"new": "success"}
    assert store.read(spark, to).count() == 5
    # by force all are made again, and replace what is there
    forced = processing.process(spark, str(tmp_path / "in"), to, "2026-02-02", readers={"pdf": pdf}, force=True)
    assert {r["status"] for r in forced.collect()} == {"success"}
    made = store.read(spark, to)
    assert made.count() == made.select("questionnaire_id").distinct().count() == 5
    assert {r[0] for r in made.select("import_provenance.fetch_date").collect()} == {"2026-02-02"}
    assert processing.reclassify(spark, to).count() == processing.reclassify(spark, to).count() == 0
    log = units.run_log(processing.results(spark.createDataFrame([("x",)], "base string"), docs)).first()
    assert (log["total_files"], log["failed"]) == (1, 1)


def test_pilot(spark):
    docs = document(spark, [UNIT | {"prompt": "<b>x"}])
    review = spark.createDataFrame([("mehozi_mm2024", "1", "חדש", [(k, "חדש") for k in "אבגד"])], "doc_id string, display_number string, prompt string, options array<struct<key:string,text:string>>")
    out = processing.pilot(docs, review=review, expected=None)
    unit = out.first()["sections"][0]["question_units"][0]
    assert unit["prompt"] == "חדש" and [o["text"] for o in unit["options"]] == ["חדש"] * 4
    r = processing.report(out).first()
    assert r["questions_detected"] == 1 and r["errors"] == [] and r["extraction_quality"] == "clean"
    assert units.batch_summary(processing.report(out)).first()["questions"] == 1


def test_incremental_rows_once(spark, tmp_path):
    from quireflow.streaming.incremental import process_new

    src, kind = str(tmp_path / "src"), "k int, v string"
    spark.createDataFrame([(1, "a"), (1, "a"), (None, "n"), (2, "b")], kind).coalesce(1).write.parquet(src)
    schema_ = spark.read.parquet(src).schema
    run = lambda: process_new(spark, src, schema_, str(tmp_path / "out"), str(tmp_path / "cp"), "k", lambda x: x)
    read = lambda: sorted(((r["k"], r["v"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=repr)
    run()
    assert read() == [(1, "a"), (2, "b"), (None, "n")]
    spark.createDataFrame([(2, "again"), (3, "c")], kind).coalesce(1).write.mode("append").parquet(src)
    run()
    run()
    assert read() == [(1, "a"), (2, "b"), (3, "c"), (None, "n")]


def test_verses_are_numbered_over_files(spark, tmp_path):
    d = tmp_path / "v"
    d.mkdir()
    for f in "ab":
        (d / f"{f}.jsonl").write_text("\n".join(f'{{"book":"{f}","chapter":1,"verse":{i},"niqqud":"x"}}' for i in range(50)) + "\n\n", encoding="utf-8")
    rows = files.read_verses(spark, str(d)).orderBy("idx").collect()
    assert [(r["idx"], r["book"], r["verse"]) for r in rows] == [(50 * k + i, f, i) for k, f in enumerate("ab") for i in range(50)]


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from quireflow import session

    class Other:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None), "master": "spark://host:7077"})

    import pytest

    with pytest.raises(RuntimeError):
        session.shared_dir(Other)
