"""Faults found in the third round: one small test for each."""

import pytest
from pyspark.sql import functions as F

from quireflow.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["documents_written", "processed"])
def test_queries_write_below_their_folder_which_is_there_already(spark, tmp_path, monkeypatch, name):
    from quireflow.plans import documents, rows

    made = tmp_path / "made"
    made.mkdir()
    monkeypatch.setattr({"documents_written": rows, "processed": documents}[name], "scratch", lambda *a: f"file://{made}")
    df = registry.QUERIES[name](spark, SF)
    assert df.count() == spark.read.parquet(f"{SF}/{'orders' if name == 'documents_written' else 'part'}.parquet").count()
    assert [p.name for p in made.iterdir()] == ["rows"]


def test_processed_keys_that_hold_a_year(spark, tmp_path):
    """Keys such as 12001 came out as documents of a year out of range."""
    part = spark.read.parquet(f"{SF}/part.parquet").limit(8).withColumn("p_partkey", F.col("p_partkey") % 8 + 12000)
    part.write.parquet(str(tmp_path / "part.parquet"))
    got = registry.QUERIES["processed"](spark, str(tmp_path)).collect()
    assert len(got) == 8 and all("out of range" not in (r["note"] or "") for r in got)
    assert {r["id"]: r["extraction_quality"] for r in got}["12001"] == "clean"


def test_copies_are_compared_once(spark, monkeypatch):
    """Rows with one core took part in every comparison of it; now only places are given to each."""
    from quireflow.operators import matching

    rows = spark.createDataFrame([(i, "abcdef" if i % 2 else "abcdxy", 0, None, i) for i in range(40)], "id int, core string, block int, year int, pos int")
    met = []
    real = matching.A.lcs
    monkeypatch.setattr(matching.A, "lcs", lambda a, b: met.append(1) or real(a, b))
    out = matching.paired(rows, rows, most=3)
    plan = out._jdf.queryExecution().analyzed().toString()
    got = {(r["left_id"], r["place"]): (r["right_id"], r["score"], r["n_candidates"]) for r in out.collect()}
    assert len(got) == 120 and got[(5, 1)] == (1, 6, 40) and got[(4, 3)] == (4, 6, 40)
    assert met == [1] and "rows" in plan
    every = matching.paired(rows, rows)
    assert every.count() == 1600 and every.where("left_id = 5 and place = 40").first()["score"] == 4


def test_emphasis_moves_no_units(spark):
    """Whole documents were keyed by a digest of their sections and joined with their units by it."""
    from quireflow.operators import emphasis
    from quireflow.plans.base import quizzes

    docs = quizzes(spark, SF).withColumn("questionnaire_id", F.col("o"))
    lines = docs.limit(1).select(F.col("o").alias("doc_id"), F.lit(0).alias("page_no"), F.lit(0).alias("line_no"), F.lit("x").alias("line"), F.array().cast("array<struct<text:string,bold:boolean,underline:boolean>>").alias("spans"))
    plan = emphasis.emphasized(docs, lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" not in plan and "posexplode" not in plan


def test_quizzes_shuffle_no_units(spark):
    """Whole units went through two exchanges; now lines do, and units are made afterwards."""
    from quireflow.plans.base import quizzes

    plan = quizzes(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Aggregate") :]
    assert "whole_unit" not in below and "whole_unit" in plan
    sorted_ = registry.QUERIES["manifest"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "sections" not in sorted_.splitlines()[0]


def test_passages_that_begin_or_end_without_a_letter(spark, tmp_path):
    """Points alone at an end of a passage were lost, or its words counted without them."""
    import duckdb

    texts = ["éè lard noir et bleu dure", "grand lard vert et béni éè.", "éç gros ène éè èé fini dure long", "petit sol bon", "été"]
    spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    c = duckdb.connect()
    c.execute(f"create view benchmark as select * from '{tmp_path}/benchmark.parquet/*.parquet'")
    got = registry.QUERIES["quotes_cleaned"](spark, str(tmp_path)).select("id", "cleaned", "is_cleaned").collect()
    assert sorted(map(tuple, got)) == sorted(c.execute(f"select id, cleaned, is_cleaned from ({registry.ORACLES['quotes_cleaned']})").fetchall())


def test_texts_become_objects_by_slices():
    """A batch of ten thousand long texts was held as Python objects at once, with its results."""
    import pyarrow as pa

    from quireflow.functions import arrow as A

    sizes, live = [], []

    class Watched(str):
        def __new__(cls, x):
            live.append(1)
            return super().__new__(cls, x)

        def __del__(self):
            live.pop()

    def f(x):
        sizes.append(len(live))
        return None if x is None else Watched(x.upper())

    got = A.by_slices(f, pa.array(["a", None, "b"] * 300))
    assert got.to_pylist() == ["A", None, "B"] * 300 and A.by_slices(f, pa.array([], pa.string())).to_pylist() == []
    assert max(sizes) <= 2 * A.AT_ONCE


def test_questionnaires_move_pages_once(spark):
    """Pages were read, grouped and joined in eight branches, each with all that made them."""
    from quireflow.operators import booklets

    pages = [("q", 1, "1. מי?\nא. דוד\nב. שאול\n2. מה?\nא. כן\nב. לא"), ("q", 2, "תשובון\nב. שאול\n1 שמות יד, כא\nא. דוד\n1 בראשית ה, ו\nא. כן\n2"), (None, 0, "דף")]
    df = spark.createDataFrame(pages, "doc_id string, page_no int, text string").repartition(3)
    out = booklets.questionnaires(df, "2026-01-01")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [doc_id") == 1 and "Join" not in plan and plan.count("Python [") == 1
    got = {r["questionnaire_id"]: r for r in out.collect()}
    first, second = got["q"]["sections"][0]["question_units"]
    assert (first["correct_option"], first["primary_sources"][0]["book"], second["correct_option"]) == ("א", "בראשית", "א")
    assert got[None]["sections"][0]["question_units"] == [] and got[None]["answer_key_location"] == "none"
    given = spark.createDataFrame([("q", 2, "ב", [])], "doc_id string, qnum int, correct_option string, refs array<struct<book:string,chapter:string,verse:string>>")
    units = {r["questionnaire_id"]: r for r in booklets.questionnaires(df, "2026-01-01", given).collect()}["q"]["sections"][0]["question_units"]
    assert [u["correct_option"] for u in units] == [None, "ב"]


def test_texts_in_lists_are_repaired():
    import pyarrow as pa

    from quireflow.functions import arrow as A

    lists = pa.array([None, [], [["ִא  ב", None], None, []], [["x"]]], pa.list_(pa.list_(pa.string()))).slice(1)
    assert A.over_lists(A.repair, lists).to_pylist() == [[], [["אִב", None], None, []], [["x"]]]
    assert A.repair("  a \t b  [פ] ") == "a b"


def test_stored_rows_stay_where_they_are(spark, tmp_path, monkeypatch):
    """Whole documents were sorted, dealt again and written twice for each upsert, and once more to be reclassified."""
    from pyspark.sql import DataFrame

    from quireflow.sources import store

    to = str(tmp_path / "s")
    monkeypatch.setattr(DataFrame, "repartition", lambda *a: pytest.fail("rows were dealt again"))
    rows = spark.range(40).selectExpr("id as k", "'a' as v", "cast(1 as int) as n")
    monkeypatch.setattr(store, "_one_each", lambda *a: pytest.fail("no key repeats"))
    assert store.upsert(rows, to, "k", buckets=4) == 1
    change = lambda df: df.withColumn("v", F.when(F.col("k") == 7, "b").otherwise(F.col("v"))).withColumn("new", F.col("k") == 7)
    assert store.rewrite(spark, to, change, "new") == 2
    got = store.read(spark, to)
    assert got.columns == ["k", "v", "n"] and got.count() == 40 and [r["k"] for r in got.where("v = 'b'").collect()] == [7]
    first, second = (store._version(spark, to, i)["places"] for i in (1, 2))
    assert len(first) == 4 and sum(first[i] != second[i] for i in first) == 1
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"


def test_repeated_keys_in_some_buckets(spark, tmp_path):
    from quireflow.sources import store

    to = str(tmp_path / "s")
    rows = spark.range(20).selectExpr("id as k", "'a' as v", "1 as n").union(spark.createDataFrame([(3, "b", 2)], "k long, v string, n int"))
    store.upsert(rows, to, "k", order="n", buckets=8)
    assert len(set(store._version(spark, to, 1)["places"].values())) == 2
    got = {r["k"]: r["v"] for r in store.read(spark, to).collect()}
    assert len(got) == 20 and store.read(spark, to).count() == 20 and got[3] == "b"


def test_drawn_files_lie_in_one_folder(spark, tmp_path, monkeypatch):
    """Each file had a folder of its own, which the driver made, moved and listed one after another."""
    from quireflow.plans import rows

    made = tmp_path / "made"
    made.mkdir()
    monkeypatch.setattr(rows, "scratch", lambda *a: f"file://{made}")
    registry.QUERIES["drawn_files"](spark, SF)
    inside = [p for p in (made / "in").iterdir() if p.suffix == ".txt"]
    assert len(inside) == spark.read.parquet(f"{SF}/supplier.parquet").count() and all(p.is_file() for p in inside)


def test_staged_pages_move_once(spark):
    """Lines of booklets met in windows, groups and joins, all held in one task; a null id had no sections, and lost those of others in its window."""
    from quireflow.operators import booklets

    text = "שלב א: בעקבות קטעי שירה\nדף\nממלכתי - דתי:\nשאלה 1\nשיר\nא. מי\nתשובות:\nא. דוד\nממלכתי:\nשאלה 2\nשיר\nא. מה\nתשובות:\nא. אור\nשלב ב: תשבצים\nתשבץ 1:\n1. (מאונך) מים (3)\nהתשובה: ים"
    first, rest = text[: text.index("\nממלכתי:")], text[text.index("ממלכתי:") :]
    rows = [("a", 0, "ב-5 נקודות"), ("a", 1, first), ("a", 2, rest), (None, 1, text), ("b", 0, "שלב א: בעקבות"), ("c", 0, None)]
    docs = booklets.staged_documents(spark.createDataFrame(rows, "doc_id string, page_no int, text string"), "2026-01-01")
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Join" not in plan and "Window" not in plan
    got = {r["questionnaire_id"]: r["sections"] for r in docs.collect()}
    names = [[(s["section_id"], [u["unit_id"] for u in s["question_units"]]) for s in got[i]] for i in ("a", None)]
    assert names[0] == names[1] == [("stage_א_mamlachti-dati", ["q01"]), ("stage_א_mamlachti", ["q02"]), ("stage_ב_all", ["crossword01"])]
    assert [s["live_stage_rules"] and s["live_stage_rules"]["points_per_correct"] for s in got["a"] + got[None]] == [5, 5, 5, None, None, None]
    assert got["a"][1]["question_units"][0]["subquestions"][0]["acceptable_answers"][0]["answer_text"] == "אור"
    assert got["b"] == [] and got["c"] == []
