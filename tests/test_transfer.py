"""Fetching with retries, one file for each row with commit, drawn pages, and the way from pages to documents."""

import os

import pytest
from pyspark.sql import functions as F

from quireflow.operators import processing
from quireflow.sources import drawn, files, store, transfer


def test_fetched(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"\x00data")
    there, missing = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    rows = spark.createDataFrame([(there,), (there,), (missing,), (None,)], "url string")
    got = {r["url"]: r for r in transfer.fetched(rows, pause=0.0).collect()}
    assert set(got) == {there, missing}
    assert (bytes(got[there]["content"]), got[there]["error"], got[there]["attempts"]) == (b"\x00data", None, 1)
    assert got[missing]["content"] is None and got[missing]["error"].startswith("URLError") and got[missing]["attempts"] == 3
    assert transfer.fetched(rows.where("false")).count() == 0


def test_fetched_tries_again_and_waits_longer(spark, tmp_path):
    mark = str(tmp_path / "tries")

    def flaky(url, timeout):
        with open(mark, "a") as f:
            f.write("x")
        if os.path.getsize(mark) < 3:
            raise ConnectionError("gone")
        return url.encode()

    r = transfer.fetched(spark.createDataFrame([("x://y",)], "url string"), opener=flaky, pause=0.01, tasks=2).first()
    assert (bytes(r["content"]), r["error"], r["attempts"]) == (b"x://y", None, 3)


def test_write_files(spark, tmp_path):
    to = str(tmp_path / "out")
    rows = spark.createDataFrame([(f"{i}.bin", bytes([i])) for i in range(20)] + [("3.bin", b"\x09"), (None, b"x"), ("n.bin", None)], "name string, content binary")
    transfer.write_files(rows.repartition(4), to)
    assert sorted(os.listdir(to)) == sorted([f"{i}.bin" for i in range(20)] + ["_SUCCESS"])
    assert (tmp_path / "out" / "3.bin").read_bytes() == b"\x09"
    transfer.write_files(rows.where("name = '5.bin'").withColumn("content", F.lit(b"new")), to)
    assert (tmp_path / "out" / "5.bin").read_bytes() == b"new" and len(os.listdir(to)) == 21


def test_a_failed_write_leaves_what_was_there(spark, tmp_path):
    to = str(tmp_path / "out")
    transfer.write_files(spark.createDataFrame([("a", b"old")], "name string, content binary"), to)
    bad = spark.range(40).repartition(4).select(F.when(F.col("id") == 39, F.raise_error(F.lit("lost"))).otherwise("a").alias("name"), F.lit(b"new").alias("content"))
    with pytest.raises(Exception, match="lost"):
        transfer.write_files(bad, to)
    with pytest.raises(Exception):  # a task of the writer itself fails
        transfer.write_files(spark.createDataFrame([("b", b"x"), ("no/such/folder", b"x")], "name string, content binary"), to)
    assert sorted(os.listdir(to)) == ["_SUCCESS", "a"] and (tmp_path / "out" / "a").read_bytes() == b"old"


def test_document_files(spark, tmp_path):
    docs = spark.createDataFrame([("א", None, ("x",)), ("b", "u", ("y",)), (None, "u", ("z",))], "questionnaire_id string, source_url string, metadata struct<track:string>")
    transfer.write_document_files(docs, str(tmp_path / "out"))
    assert (tmp_path / "out" / "א.json").read_text() == '{"questionnaire_id":"א","source_url":null,"metadata":{"track":"x"}}\n'
    back = {r["questionnaire_id"]: r["metadata"]["track"] for r in files.read_documents(spark, str(tmp_path / "out")).collect()}
    assert back == {"א": "x", "b": "y"}


# --- drawn pages

TEXT = ["שער", "שאלה ארוכה מספיק כדי שיהיה מה לקרוא בקובץ הזה באמת"]


def ink():
    """A parser, made here so that workers get it by value."""

    def parser(data):
        """A page of text lines, drawn from right to left, the last word of each underlined, and a page number."""
        if data == b"broken":
            raise ValueError("no page")
        for text in data.decode().split("\f"):
            chars, shapes = [], []
            for n, line in enumerate(x for x in text.split("\n") if x):
                top = 100.0 + 20 * n
                chars += [(c, 10.0 * i, 10.0 * i + 9, top, top + 10, "Some") for i, c in enumerate(reversed(line))]
                shapes.append((0.0, 10.0 * len(line.split(" ")[-1]), top + 12, top + 13))
            number = ("12", 50.0, 60.0, 985.0, 995.0)
            yield drawn.Page(1000.0, [*chars, ("1", 50.0, 55.0, 985.0, 995.0, "Some"), ("2", 55.0, 60.0, 985.0, 995.0, "Some")], [number], shapes)

    return parser


def test_read_drawn(spark, tmp_path):
    (tmp_path / "a.ink").write_text("\n".join(TEXT) + "\f\f" + TEXT[1])
    (tmp_path / "b.ink").write_bytes(b"broken")
    (tmp_path / "c.other").write_bytes(b"x")
    objects = drawn.read_drawn(spark, str(tmp_path), {"ink": ink()})
    assert {r[0] for r in objects.select("doc_id").distinct().collect()} == {"a", "b"}
    assert drawn.part_of(objects, "page").where("doc_id = 'a' and height = 1000").count() == 3
    assert [r["text"] for r in objects.where("doc_id = 'b'").collect()] == ["no page"]
    got = {r["doc_id"]: r for r in processing.drawn_texts(objects).collect()}
    assert got["a"]["pages"] == ["\n".join(TEXT), "", TEXT[1]] and got["a"]["error"] is None and got["a"]["kind"] == "ink"
    assert got["b"]["pages"] is None and got["b"]["error"] == "no page"


def test_process_reads_drawn_pages_and_marks_emphasis(spark, tmp_path):
    (tmp_path / "in").mkdir()
    page = "\n".join(["1. מי היה המלך הראשון", "א. שאול", "ב. דוד", "ג. שלמה", "ד. רחבעם"])
    (tmp_path / "in" / "mehozi_mm2024.pdf").write_text("שער\nשורה ארוכה של אותיות שאין בה שום שאלה ושום תשובה\f" + page)
    (tmp_path / "in" / "bad.pdf").write_bytes(b"broken")
    to = str(tmp_path / "out")
    got = {r["id"]: r for r in processing.process(spark, str(tmp_path / "in"), to, "2026-01-01", parsers={"pdf": ink()}).collect()}
    assert got["bad"]["extraction_quality"] == "unreadable" and got["mehozi_mm2024"]["question_count"] == 1
    doc = store.read(spark, to).where("questionnaire_id = 'mehozi_mm2024'").first()
    unit = doc["sections"][0]["question_units"][0]
    assert unit["prompt"] == "מי היה המלך <u>הראשון</u>" and [o["text"] for o in unit["options"]] == ["שאול", "דוד", "שלמה", "רחבעם"]


def test_run_batch(spark, tmp_path):
    """Three ids: one that a page links to, one tried under the base address, one that isn't anywhere."""
    (tmp_path / "web" / "files").mkdir(parents=True)
    page = "\n".join(["1. מי היה המלך הראשון", "א. שאול", "ב. דוד", "ג. שלמה", "ד. רחבעם"])
    text = "שער\nשורה ארוכה של אותיות שאין בה שום שאלה ושום תשובה\f" + page
    (tmp_path / "web" / "files" / "mehozi_mm2024.pdf").write_text(text)
    (tmp_path / "web" / "artzi_mm2023.pdf").write_text(text)
    pages = spark.createDataFrame([(0, f'<a href="file://{tmp_path}/web/files/mehozi_mm2024.pdf">x</a>')], "page_id long, html string")
    found = files.discovered(pages.withColumn("html", F.regexp_replace("html", "file://", "http+file://")))
    found = found.withColumn("url", F.regexp_replace("url", r"^http\+", ""))
    ids = spark.createDataFrame([("mehozi_mm2024",), ("artzi_mm2023",), ("olami_mm2022",)], "base string")
    to = str(tmp_path / "out")
    run = lambda **more: {r["questionnaire_id"]: r for r in processing.run_batch(spark, ids, found, to, "2026-01-01", f"file://{tmp_path}/web/", parsers={"pdf": ink()}, pause=0.0, **more).collect()}
    got = run()
    assert {k: (r["questions_detected"], r["error"] is None) for k, r in got.items()} == {"mehozi_mm2024": (1, True), "artzi_mm2023": (1, True), "olami_mm2022": (None, False)}
    assert got["olami_mm2022"]["error"].startswith("URLError") and got["mehozi_mm2024"]["with_html_formatting"] == 1
    assert sorted(os.listdir(tmp_path / "out" / "reports")) == ["_SUCCESS", "artzi_mm2023.report.json", "mehozi_mm2024.report.json"]
    (tmp_path / "web" / "olami_mm2022.pdf").write_text(text)
    again = run(force=True)
    assert {k: r["error"] for k, r in again.items()} == dict.fromkeys(got)
    assert store.read(spark, f"{to}/documents").count() == 3
