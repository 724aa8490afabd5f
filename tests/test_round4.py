"""Faults that the findings of round 4 named."""

import duckdb

from quireflow.plans import registry


def test_verses_of_odd_texts(spark, tmp_path):
    """Texts with tags, entities, brackets, accents or odd spaces lost them, an empty one lost its space."""
    texts = ["", " \n", None, "plain text", "a < b", "a <b> c</i>", "> &amp; &lt;b&gt; &#65; &nbsp &copy", "&&& AT&T &", "() (o) [q] {} {O} (c) ((o)) (", "[\n]", "a\x0bb\x85c\xa0 \xa0d   e　",
             "\xa0a\xa0", " \t\f\r a  b \n", "ב֑־ג׃ ֽֿ׀ׅׄ׆ ְׁ", "֑", "caf\xe9 {ס} [פ]", "<", "&", "{֑}"]
    name = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(name)
    got = {r["doc_id"]: r["verse"] for r in registry.QUERIES["clean_verse"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{name}/*.parquet'")
    want = dict(con.execute(registry.ORACLES["clean_verse"]).fetchall())
    assert len(want) == len(texts) and [texts[i] for i in want if got[i] != want[i]] == []


def test_what_a_question_has_is_looked_for_once(spark):
    """Of each segment the book was looked for a dozen times, and of options that aren't numbers all were trimmed."""
    from pyspark.sql import functions as F

    from quireflow.functions import text as T

    text = 'שמות א, ב; ג; דה"א ד, 5-3; zz 5; שמות; בראשית י; ה, ו - ז.'
    df = spark.createDataFrame([(text,), ("",), (None,), ("; ג, ד",)], "x string").select("x", T.source_refs(F.col("x")).alias("refs"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract(") <= 6
    got = [[tuple(r) for r in row["refs"]] for row in df.collect()]
    chronicles = "דברי הימים א"
    assert got[0][:3] == [("שמות", "א", "ב"), ("שמות", "ג", None), (chronicles, "ד", "ג-ה")] and got[0][-2:] == [("בראשית", "י", None), ("בראשית", "ה", "ו-ז")] and got[1:] == [[], [], []]
