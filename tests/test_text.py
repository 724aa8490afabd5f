import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quireflow.functions import arrow as A
from quireflow.functions import text as T
from quireflow.operators import quotes


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")])
    return row.select(column.alias("out")).first()["out"]


def many(spark, column, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in rows.select("i", column.alias("out")).orderBy("i").collect()]


def test_numbers(spark):
    assert many(spark, T.numeral(F.col("v")), [0, 5, 15, 16, 29, 30, 31, 115, 416], "int") == ["", "ה", "טו", "טז", "כט", "ל", "לא", "קטו", "תטז"]
    assert many(spark, T.letter_sum(F.col("v")), ["טז", "קנ", "ם", "abc", "", None]) == [16, 150, 40, 0, 0, 0]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(1, 499), min_size=1, max_size=30))
def test_numerals_sum_to_their_number(spark, ns):
    assert many(spark, T.letter_sum(T.numeral(F.col("v"))), ns, "int") == ns


def test_points_and_skeletons(spark):
    assert many(spark, T.strip_points(F.col("v")), ["שָׁלוֹם", "abc"]) == ["שלום", "abc"]
    assert many(spark, T.skeleton(F.col("v")), ["מֶלֶךְ דוד!", None]) == ["מלכדוד", ""]
    assert many(spark, T.quote_stream(F.col("v")), ["ויאמר ה' אל משה"]) == ["ויאמריהוהאלמשה"]


def test_source_refs(spark):
    refs = many(spark, T.source_refs(F.col("v")), ["שמות יד, כא; טו, כה; במדבר כ, יא", "בראשית ה, 16-15", 'שמ"א ג, ד', "שמות יד", "כב, ג", "", None])
    assert [tuple(r) for r in refs[0]] == [("שמות", "יד", "כא"), ("שמות", "טו", "כה"), ("במדבר", "כ", "יא")]
    assert [tuple(r) for r in refs[1]] == [("בראשית", "ה", "טו-טז")]
    assert [tuple(r) for r in refs[2]] == [("שמואל א", "ג", "ד")]
    assert [tuple(r) for r in refs[3]] == [("שמות", "יד", None)]
    assert refs[4] == refs[5] == refs[6] == []


def test_widened_and_english(spark):
    ref = F.struct(F.lit("שמות").alias("book"), F.lit("יד").alias("chapter"), F.col("v").alias("verse"))
    assert many(spark, T.widened(ref)["verse"], ["ל", "א", None, ""]) == ["כח-לא", "א-ב", None, ""]
    assert many(spark, T.english_ref(ref), ["ל", "ה-ז", None]) == ["Exodus 14:30", "Exodus 14:5-7", "Exodus 14"]


@pytest.mark.parametrize(
    "name, track, stage, year, age",
    [
        ("beitsifri_mmd2026", "mamlachti_dati", "school", 2026, "youth"),
        ("mehozi_mm2024", "mamlachti", "district", 2024, "youth"),
        ("2013md", None, None, 2013, None),
        ("QMehoziMamad23", None, "district", None, "youth"),
        ("PreMm25", "mamlachti", "national", 2025, None),
        ("adults_2020", "mamlachti", "national", 2020, "adult"),
        ("olami_mamad_2019", "mamlachti_dati", "world", 2019, "youth"),
    ],
)
def test_decode_id(spark, name, track, stage, year, age):
    assert tuple(one(spark, T.decode_id(F.lit(name)))) == (track, stage, year, age)


def test_tags(spark):
    cases = ["<b>x</b>", "<b>x", "x</u>", "<b><u>x</b></u>", "<div>x</div>", "plain", None]
    sizes = [len(x) for x in many(spark, T.tag_errors(F.col("v")), cases)]
    assert sizes[0] == sizes[5] == sizes[6] == 0 and all(sizes[1:5])
    assert many(spark, T.sanitize(F.col("v")), ["<b>x</b>", "<b>x", "a<div>x</div>"]) == ["<b>x</b>", "x", "ax"]
    assert many(spark, T.comparable(F.col("v")), [" a  <b>b</b>\n c "]) == ["a b c"]


def test_question_types(spark):
    kind = "struct<p:string,o:array<struct<key:string,text:string>>>"
    rows = [("מי אמר?", [("א", "דוד")]), ("כמה?", [("א", "3"), ("ב", "12")]), ("מי לא היה שם", [("א", "דוד")]), ("מתי", [("א", "אז")]), ("מתי", [])]
    assert many(spark, T.question_type(F.col("v.p"), F.col("v.o")), rows, kind) == ["speaker_id", "numeric", "negative_exclusion", "multiple_choice", "multiple_choice"]


def test_narrative_split(spark):
    got = many(spark, T.narrative_split(F.col("v")), ['מי אמר: "וַיֹּאמֶר אֱלֹהִים יְהִי אוֹר"?', "איזה מֶלֶךְ מלך אז?", "מה וַיֹּאמֶר אֱלֹהִים יְהִי אוֹר קרה"])
    assert tuple(got[0]) == ("וַיֹּאמֶר אֱלֹהִים יְהִי אוֹר", "מי אמר?")
    assert tuple(got[1]) == (None, "איזה מֶלֶךְ מלך אז?")
    assert tuple(got[2]) == ("וַיֹּאמֶר אֱלֹהִים יְהִי אוֹר", "מה קרה?")


def test_alternates(spark):
    got = many(spark, T.alternates(F.col("v")), ["גבעת האלהים (יתקבל גם: גבעה / הגבעה)", "דוד (אם המתמודד עונה כך)", "שלמה", None])
    assert (got[0]["primary"], got[0]["alternates"]) == ("גבעת האלהים", ["גבעה", "הגבעה"])
    assert (got[1]["primary"], got[1]["note"]) == ("דוד", "(אם המתמודד עונה כך)")
    assert got[2]["primary"] == "שלמה" and got[3]["primary"] == ""


def test_furniture_and_marks(spark):
    assert many(spark, T.ends_with_furniture(F.col("v")), ["אביגיל 5", "5", "12", "בשנת 1948 ", None]) == [True, False, False, False, False]
    assert many(spark, T.detached_or_lost(F.col("v")), ["אב ְג", "אבג", "א�", None]) == [True, False, True, False]
    assert many(spark, T.clean_question(F.col("v")), ["מי  זה :?", "", "מה"]) == ["מי זה?", "", "מה?"]


def test_live_rules(spark):
    rules = one(spark, T.live_rules(F.lit("כל תשובה נכונה תזכה ב-5 נקודות. כל רמז נוסף יגרע 2 נקודות. לרשות המתמודד 45 שניות")))
    assert tuple(rules) == (5, 2, 45)


BROKEN = ["וַיֹּאמֶר", " ֵּהא", "וְ הִ נְ נִי אֹ מֵר", "שלום  עולם {ס}", ""]


def test_repair(spark):
    got = many(spark, A.repaired(F.col("v")), [*BROKEN, None])
    assert got[2] == "וְהִנְנִי אֹמֵר" and got[3] == "שלום עולם" and got[4] == "" and got[5] is None
    assert all(not w or not ("֑" <= w[0] <= "ׇ") for x in got[:3] for w in x.split(" "))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="אבגםד ְִֹּ\t(){}ספ1", max_size=30))
def test_repair_is_idempotent_on_marks(s):
    once = A.repair(s)
    assert A.repair(once) is not None and not any(w and "֑" <= w[0] <= "ׇ" and len(w) > 1 and "א" <= w[-1] <= "ת" and w[:-1].strip("ְִֹּ֑") == "" for w in once.split(" "))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc", max_size=12), st.text(alphabet="abc", max_size=12))
def test_common_substring(a, b):
    expect = max([len(a[i:j]) for i in range(len(a)) for j in range(i + 1, len(a) + 1) if a[i:j] in b], default=0)
    assert A.common_substring(a, b) == expect


def test_visual_order(spark):
    assert many(spark, A.logical(F.col("v")), ["םולש 21", "", None]) == ["21 שלום", "", None]


def test_alignment(spark):
    verse = "וַיֹּאמֶר יְהוָה אֶל מֹשֶׁה לֵּאמֹר"
    rows = spark.createDataFrame(
        [(0, "ויאמר ה' אל משה", verse), (1, "אל משה לאמר", verse), (2, "דברים אחרים לגמרי", verse), (3, "ויאמר יהוה ... משה לאמר", verse), (4, "אל", verse), (5, None, verse), (6, "אל משה", None), (7, "", "")],
        "i int, quote string, text string",
    )
    got = {r["i"]: r["aligned"] for r in quotes.with_alignment(rows).collect()}
    assert got[0] == "וַיֹּאמֶר ה' אֶל מֹשֶׁה" and got[1] == "אֶל מֹשֶׁה לֵּאמֹר"
    assert got[3] == "וַיֹּאמֶר יְהוָה … מֹשֶׁה לֵּאמֹר"
    assert got[2] is got[4] is got[5] is got[6] is got[7] is None


def place_by_trial(part, hay, after):
    """Every start followed to its earliest end."""
    found = []
    for start in range(len(hay)):
        at = start - 1
        for c in part:
            at = hay.find(c, at + 1)
            if at < 0:
                break
        if at >= 0 and hay[start] == part[0] and at + 1 - start <= 2 * len(part) + 6:
            found.append((start < after, at + 1 - start, start))
    return (min(found)[2], min(found)[1]) if found else None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("אבג", min_size=1, max_size=4), max_size=3), st.text("אבגד", max_size=25))
def test_places(parts, hay):
    after, expect = 0, []
    for p in parts:
        expect.append(place_by_trial(p, hay, after))
        after = sum(expect[-1]) if expect[-1] else after
    assert A.places(parts, hay) == expect


def test_emphasis():
    lines = [{"line": "מי לא היה שם", "spans": [{"text": "לא", "bold": True, "underline": False}]}]
    assert A.emphasize("מי לא היה שם", lines) == "מי <b>לא</b> היה שם"
    assert A.emphasize("שאלה אחרת", lines) == "שאלה אחרת"
