"""Containment by rare grams, the stored verse index, pairing by prefixes, keyed state, and columns with clashing names."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from quireflow.operators import containment, emphasis, matching, processing, quotes, verse_index
from quireflow.sources import files
from quireflow.streaming.incremental import process_new

# --- containment

WORDS = ["the", "and", "of", "אבג", "日本", "😀", "xyzzy", "a"]


@pytest.mark.parametrize("seed", [1, 2])
def test_contained_by_index_equals_the_automaton_and_brute_force(spark, seed):
    rng = random.Random(seed)
    hays = [(i if i % 7 else None, " ".join(rng.choices(WORDS, k=rng.randint(0, 40)))) for i in range(120)] + [(500, None), (501, ""), (3, "the and of the and of")] * 2
    long = next(h for _, h in hays if h and len(h) > 60)
    needles = [(i, " ".join(rng.choices(WORDS, k=rng.randint(1, 6)))) for i in range(60)] + [(100, ""), (101, None), (None, "of"), (102, "e"), (103, long), (104, long[5:50]), (105, "the and of the and"), (105, "the and of the and"), (106, "no such thing at all")]
    n = spark.createDataFrame(needles, "n long, text string")
    h = spark.createDataFrame(hays, "h long, text string").repartition(3)
    want = sorted(((i, j, x.index(y) + 1) for (i, y), (j, x) in itertools.product(needles, hays) if y and x and y in x), key=repr)
    for most, characters in ((1000, 1 << 20), (0, 1 << 20), (1000, 10)):
        got = matching.contained(n, h, "n", "h", most=most, characters=characters)
        assert sorted(map(tuple, got.select("n", "h", "at").collect()), key=repr) == want
    assert matching.contained(n.where("false"), h, "n", "h", most=-1).count() == 0
    assert matching.contained(n, h.where("false"), "n", "h", most=0).count() == 0


def test_a_needle_is_looked_up_by_its_rarest_gram(spark):
    """A gram that every hay has is never taken by a needle that has another."""
    hays = spark.createDataFrame([(i, "in the beginning " * 20 + f"{i:04d}") for i in range(50)], "hay long, text string")
    needles = spark.createDataFrame([("in the beginning 0007",), ("beginning 0008",)], "needle string")
    chosen = containment._chosen(needles, containment._histogram(hays, [8])).collect()
    hot = set(containment.gram_hashes("in the beginning " * 2, 8).view("int64").tolist())
    assert len(chosen) == 2 and not {r["hash"] for r in chosen} & hot
    assert sorted((r["needle"], r["hay"]) for r in containment.located(needles, hays).collect()) == [("beginning 0008", 8), ("in the beginning 0007", 7)]


# --- the verse index

LETTERS = "אבגדהוזחטיכלמנסעפצקרשת"


def verse_rows(spark, texts):
    return spark.createDataFrame([(i, "ספר", 1, i + 1, x) for i, x in enumerate(texts)], "idx long, book string, chapter int, verse int, niqqud string")


def places_plainly(texts, anchor):
    own = ["".join(c for c in x if c in LETTERS) for x in texts]
    owner = [i for i, x in enumerate(own) for _ in x]
    stream = "".join(own)
    found = [i for i in range(len(stream) - len(anchor) + 1) if stream.startswith(anchor, i)]
    return sorted((owner[i], owner[i + len(anchor) - 1], i) for i in found if owner[i + len(anchor) - 1] - owner[i] < verse_index.REACH)


def test_places(spark, tmp_path):
    rng = random.Random(4)
    texts = ["".join(rng.choices("אבג ", k=rng.choice([0, 1, 3, 40, 700]))) for _ in range(60)] + [None, "abc"]
    stream = "".join(c for x in texts for c in x or "" if c in LETTERS)
    anchors = [stream[i : i + n] for n in (6, 7, 30, 300, 900) for i in rng.sample(range(len(stream) - n), 12)] + [stream[:6], stream[-6:], "דדדדדד", "אבגדהו", "אבג"]
    rows = spark.createDataFrame(list(enumerate(anchors)), "q long, anchor string")
    index = verse_index.kept_index(verse_rows(spark, texts), str(tmp_path / "index"))
    got = {}
    for r in verse_index.places(rows, index, ["q"]).collect():
        got.setdefault(r["q"], []).append((r["first"], r["last"], r["at"]))
    plain = [x or "" for x in texts]
    assert {q: sorted(x) for q, x in got.items()} == {q: p for q, a in enumerate(anchors) if (p := places_plainly(plain, a) if len(a) >= 6 else [])}


def test_the_index_is_made_once_and_never_moved(spark, tmp_path):
    to = str(tmp_path / "index")
    verses = verse_rows(spark, ["אבגדהוזחט", "יכלמנסעפצ", "קרשתאבגדה"])
    verse_index.kept_index(verses, to)
    written = {p: os.path.getmtime(p) for d, _, names in os.walk(to) for n in names if (p := os.path.join(d, n))}
    for name in ("grams", "counts"):  # as a new session, which knows no table
        spark.sql(f"drop table {verse_index._table(to, name)}")
    index = verse_index.kept_index(verses.where("false"), to)
    assert {p: os.path.getmtime(p) for p in written} == written
    q = spark.createDataFrame([(1, "חט יכל מנס")], "quote_id long, quote string")
    assert [tuple(r) for r in quotes.located(q, verses, index=index).collect()] == [(1, 0, 1)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        anchors = q.select("quote_id", F.lit("חטיכלמנ").alias("anchor"))
        plan = verse_index.places(anchors, index, ["quote_id"])._jdf.queryExecution().executedPlan().toString()
        scan = next(x for x in plan.split("SortMergeJoin") if "verse_grams" in x or f"{to}/grams" in x)
        assert "SelectedBucketsCount" in plan or "Bucketed: true" in plan
        above = scan[: scan.index("FileScan")].rsplit(":- ", 1)[-1].rsplit("+- ", 3)
        assert not any("Exchange" in x for x in above[-2:])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# --- pairing by prefixes

def common(a, b):
    return max((n for n in range(1, min(len(a), len(b)) + 1) for i in range(len(a) - n + 1) if a[i : i + n] in b), default=0)


@pytest.mark.parametrize("least, share, gram", [(4, 0.4, 4), (4, 0.0, 4), (2, 0.8, 4), (5, 0.5, 3), (1, 0.1, 1)])
def test_paired_equals_brute_force(spark, least, share, gram):
    rng = random.Random(least)
    core = lambda: "".join(rng.choices(["kupa", "mako", "ab", "rel", "o", "x"], k=rng.randint(0, 7)))
    rows = lambda n: [(i, core(), rng.choice(["p", "q", None]), rng.choice([None, 2020, 2021]), i % 5) for i in range(n)]
    l, r = rows(60), rows(70)  # noqa: E741
    kind = "id long, core string, block string, year int, pos int"
    got = matching.paired(spark.createDataFrame(l, kind), spark.createDataFrame(r, kind), least, share, gram).collect()
    want = {}
    for a, b in itertools.product(l, r):
        if a[2] == b[2] is not None and (a[3] is None or b[3] is None or a[3] == b[3]):
            s = common(a[1], b[1])
            if s >= least and s >= share * min(len(a[1]), len(b[1])):
                want[a[0], b[0]] = s
    assert {(x["left_id"], x["right_id"]): x["score"] for x in got} == want
    for x in got:
        assert x["place"] <= x["n_candidates"]


def test_a_high_share_compares_few(spark):
    """With a share of 0.8 a core asks by its rarest grams only: the gram that all have makes no candidates."""
    rows = [(i, f"{'abcdefghijklmnopqrstuvwxyz'[i % 26] * 2}{i:04d}{'zq' * 3}tail", "b", None, i) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, core string, block string, year int, pos int")
    got = matching.paired(df, df, share=0.8).collect()
    assert {r["left_id"] for r in got if r["left_id"] == r["right_id"]} == set(range(300))
    assert max(r["n_candidates"] for r in got) < 150


# --- keyed state

def test_keyed_state(spark, tmp_path):
    src, to, kind = str(tmp_path / "src"), str(tmp_path / "out"), "k int, v string, ts timestamp"
    at = lambda n: f"2026-01-{n:02d} 00:00:00"

    def arrive(*rows):
        df = spark.createDataFrame(list(rows), "k int, v string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("at", F.lit("own"))
        df.coalesce(1).write.mode("append").parquet(src)
        process_new(spark, src, df.schema, to, str(tmp_path / "cp"), "k", lambda x: x, event_time="ts", delay="3 days")
        return sorted(((r["k"], r["v"]) for r in spark.read.parquet(to).collect()), key=repr)

    assert kind and arrive((1, "a", at(10)), (1, "a", at(10)), (2, "b", at(9)), (None, "n", at(1))) == sorted([(1, "a"), (2, "b"), (None, "n")], key=repr)
    # known keys stay out; a row at the watermark (the 7th) is late, one above it isn't
    assert arrive((2, "again", at(11)), (3, "late", at(7)), (4, "in time", at(8)), (None, "n", at(1))) == sorted([(1, "a"), (2, "b"), (4, "in time"), (None, "n"), (None, "n")], key=repr)
    os.rename(to, to + "-gone")  # the output isn't read
    assert arrive((1, "again", at(12)), (5, "new", at(12))) == [(5, "new")]
    # beyond the watermark (the 27th) a key may come again
    os.rename(to, to + "-gone2")
    arrive((6, "far", at(30)))
    assert (1, "later") in arrive((1, "later", at(29)))


# --- columns of any name

def with_clashes(df, *names):
    """``df`` with further columns of the names that operators use themselves."""
    for n in names:
        if n not in df.columns:
            df = df.withColumn(n, F.lit("own"))
    return df


MINE = ["r", "_r", "k", "key", "_key", "warnings", "hit", "_hit", "seen", "_seen", "exists", "quote", "aligned", "_needle", "_hay", "_text", "_in", "needle", "hay", "row", "hash", "_row", "_words", "new", "_new", "_lines", "errors", "_errors", "cell", "_cell", "w", "i", "gram", "doc", "pos", "near", "was", "m", "l", "e", "g", "in_e", "_e", "o", "cleaned", "is_cleaned", "underline", "struct"]


def test_clashing_columns(spark):
    c = lambda df: with_clashes(df, *MINE)
    opts = [(k, "טקסט") for k in "אבגד"]
    kind = "doc_id string, display_number string, prompt string, options array<struct<key:string,text:string>>"
    units_, review = spark.createDataFrame([("d", "1", "ישן", opts)], kind), spark.createDataFrame([("d", "1", "חדש", opts)], kind)
    out = matching.merged_review(c(units_), c(review))
    assert out.first()["prompt"] == "חדש" and out.first()["warnings"] == "own" and out.first()["warnings_"] == [] and out.columns[:-1] == c(units_).columns
    n, h = spark.createDataFrame([(1, "ab")], "n long, text string"), spark.createDataFrame([(2, "xab")], "h long, text string")
    for most in (10, 0):
        assert [tuple(r) for r in matching.contained(c(n), c(h), "n", "h", most=most).collect()] == [(1, 2, 2)]
    lines = c(spark.createDataFrame([("x", 1, "a"), ("x", 2, "b")], "_d string, _p long, _t string"))
    assert [tuple(r) for r in matching.window_context(lines, "_d", "_p", F.col("_p") == 1, "_t").collect()] == [("x", 1, "a b")]
    assert files.planned(c(spark.createDataFrame([("a",), ("b",)], "base string")), c(spark.createDataFrame([("a",)], "base string"))).columns[-1] == "exists_"
    words = spark.createDataFrame([("d", 0, 0, 0.0, 5.0, 10.0, 12.0)], "doc_id string, page_no int, word_no int, x0 double, x1 double, top double, bottom double")
    rules = words.select("doc_id", "page_no", "x0", "x1", F.lit(13.0).alias("top"))
    under = matching.underlined(c(words), c(rules)).first()
    assert under["underline"] == "own" and under["underline_"]
    pages = c(spark.createDataFrame([("d", 0, 100.0)], "doc_id string, page_no int, height double"))
    chars = spark.createDataFrame([("d", 0, 0, "7", 1.0, 2.0, 1.0, 2.0)], "doc_id string, page_no int, char_no int, text string, x0 double, x1 double, top double, bottom double")
    assert matching.without_page_numbers(c(chars), c(chars.withColumn("word_no", F.lit(0))), pages).count() == 0
    rows = spark.createDataFrame([("a", 1)], "id string, x int")
    assert matching.diff(c(rows), c(rows.withColumn("x", F.lit(2))), "id", ["x"]).first()["x_differs"]
    verses = spark.createDataFrame([(0, "ב", 1, 1, "בְּרֵאשִׁית בָּרָא אֱלֹהִים אֵת הַשָּׁמַיִם")], "idx long, book string, chapter int, verse int, niqqud string")
    said = c(spark.createDataFrame([(1, 'אמר "ברֵאשִׁית בָּרָא אֱלֹהִים אֵת" לו')], "id long, text string"))
    cleaned = quotes.cleaned_inline(said, c(verses)).first()
    assert cleaned["quote"] == cleaned["cleaned"] == "own" and cleaned["cleaned_"] == 'אמר "בְּרֵאשִׁית בָּרָא אֱלֹהִים אֵת" לו' and cleaned["is_cleaned_"]
    core = spark.createDataFrame([(1, "abcdef", "b", None, 0)], "id long, core string, block string, year int, pos int")
    assert matching.paired(c(core), c(core)).first()["score"] == 6


def test_clashing_columns_of_documents(spark):
    from test_operators import UNIT, document

    docs = with_clashes(document(spark, [UNIT]), *MINE)
    assert processing.with_failures(docs).first()["errors"] == "own"
    line = spark.createDataFrame([("mehozi_mm2024", 0, 0, UNIT["prompt"], [(UNIT["prompt"].split(" ")[0], True, False)])], "doc_id string, page_no int, line_no int, line string, spans array<struct<text:string,bold:boolean,underline:boolean>>")
    out = emphasis.emphasized(docs, line).first()
    assert "<b>" in out["sections"][0]["question_units"][0]["prompt"] and out["_key"] == "own"
