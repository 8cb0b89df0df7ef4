from __future__ import annotations

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quirework.functions.repeats import is_loop
from quirework.operators import assemble, labels, model, ordinals, parse, progress, resume, toc
from quirework.plans import pipeline

ARTIFACT = "doc_id string, page_num int, raw_html string, markdown string, html_filtered string, page_box array<int>, token_count int, error boolean, error_message string, chunks array<struct<bbox: array<int>, label: string, content: string>>, image_files array<string>"


def artifact(doc, page, text="t", tokens=None, error=False):
    return (doc, page, "r", text, f"<p>{text}</p>", [0, 0, 10, 20], 100 + page if tokens is None else tokens, error, None, [([0, 0, 1, 1], "Text", text)], [])


@pytest.fixture(scope="module")
def artifacts(spark):
    rows = [artifact("a", p, f"p{p}") for p in (3, 0, 2, 1)] + [artifact("b", 5, "x"), artifact("b", 5, "x"), artifact("b", 7, "", 0, True), artifact("b", 7, "y", error=None)]
    return spark.createDataFrame(rows, ARTIFACT)


def test_pages_are_merged_in_order(artifacts):
    got = {r["doc_id"]: r for r in assemble.assemble(artifacts).collect()}
    assert got["a"]["markdown"] == "p0\n\np1\n\np2\n\np3" and got["a"]["num_pages"] == 4
    assert got["b"]["html"] == "<p>x</p>\n\n<p>y</p>" and got["b"]["num_pages"] == 2


def test_separators_count_the_pages_of_the_run(artifacts):
    got = {r["doc_id"]: r for r in assemble.assemble(artifacts, paginated=True).collect()}
    rule = "-" * 48
    assert got["b"]["markdown"] == f"x\n\n1{rule}\n\ny" and got["b"]["html"] == "<p>x</p>\n\n<!-- Page 2 -->\n\n<p>y</p>"


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_parts_make_up_the_document(artifacts, size):
    parts = assemble.assemble_parts(artifacts, True, part_pages=size).orderBy("doc_id", "part").collect()
    whole = {r["doc_id"]: r["markdown"] for r in assemble.assemble(artifacts, True).collect()}
    for doc in whole:
        assert "".join(p["markdown"] for p in parts if p["doc_id"] == doc) == whole[doc]


def test_null_texts_count_as_empty(spark):
    rows = [("a", 0, None, None, None, None, None, None, None, None, None), ("a", 1, "r", "m", "h", None, 5, False, None, None, None)]
    df = spark.createDataFrame(rows, ARTIFACT)
    assert assemble.assemble(df).first()["markdown"] == "\n\nm"
    assert assemble.document_metadata(df).first().asDict() == {"doc_id": "a", "num_pages": 2, "total_token_count": 5, "total_chunks": 0, "total_images": 0, "failed_pages": 0}


def test_metadata(spark, artifacts):
    got = {r["doc_id"]: r for r in assemble.document_metadata(artifacts).collect()}
    assert got["a"]["total_token_count"] == 100 + 101 + 102 + 103 and got["a"]["total_chunks"] == 4 and got["b"]["failed_pages"] == 0
    body = assemble.metadata_json(artifacts, spark.createDataFrame([("a", "a.pdf")], "doc_id string, file_name string")).where("doc_id = 'a'").first()["metadata"]
    assert body.startswith('{"file_name":"a.pdf","num_pages":4,"total_token_count":406') and '"page_num":3' in body


def test_chunks_keep_their_place(artifacts):
    got = assemble.document_chunks(artifacts).where("doc_id = 'a'").orderBy("page_num", "position").select("page_num", "content").collect()
    assert [tuple(r) for r in got] == [(k, f"p{k}") for k in range(4)]


def test_running_number_against_one_sort(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aab") if rng.random() < 0.9 else None, rng.randint(0, 50), k) for k in range(400)]
    df = spark.createDataFrame(rows, "k string, v int, id int")
    got = {r["id"]: r["n"] for r in ordinals.running_number(df, ["k"], F.floor(F.col("v") / 7), ["v", "id"], "n").collect()}
    for key in {r[0] for r in rows}:
        for place, row in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])), 1):
            assert got[row[2]] == place


def test_global_number_against_one_sort(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 9), k) for k in range(300)]
    got = {r["id"]: r["n"] for r in ordinals.global_number(spark.createDataFrame(rows, "v int, id int").repartition(7), ["v", "id"], "n").collect()}
    assert [got[k] for _, k in sorted(rows)] == list(range(1, 301))


def test_resume(spark, artifacts):
    states = spark.createDataFrame([("a", 1, ("/a", 10, 5.0), [0, 1, 2, 3, 4]), ("b", 1, None, [5, 7]), ("b", 2, ("/b", 7, 1.0), [7]), ("c", 1, ("/c", 1, 1.0), [])], "doc_id string, run_no int, source struct<path: string, size: bigint, mtime: double>, expected_pages array<int>")
    expected = resume.expected_pages(states)
    assert [tuple(r) for r in resume.pending_pages(expected, artifacts).collect()] == [("a", 4)]
    assert {r["doc_id"]: r["complete"] for r in resume.completeness(expected, artifacts).collect()} == {"a": False, "b": True}
    files = spark.createDataFrame(
        [("a", 10, datetime.fromtimestamp(5.9)), ("b", 7, datetime.fromtimestamp(2.0)), ("c", 2, datetime.fromtimestamp(1.0))], "doc_id string, length bigint, modification_time timestamp"
    )
    got = {(r["doc_id"], r["run_no"]): r["matches"] for r in resume.fingerprints(files, states).collect()}
    assert got == {("a", 1): True, ("b", 1): False, ("b", 2): False, ("c", 1): False}  # a whole second apart is another file
    assert {r["doc_id"] for r in resume.drop_stale(artifacts, resume.fingerprints(files, states)).collect()} == {"a"}
    last = {r["doc_id"]: r["run_no"] for r in resume.latest_state(states).collect()}
    assert last == {"a": 1, "b": 2, "c": 1}


def test_range_that_begins_late(spark):
    docs = spark.createDataFrame([("a", 10)], "doc_id string, total_pages int")
    pages = resume.plan_pages(docs, F.array(F.lit(4), F.lit(5), F.lit(6), F.lit(12)))
    assert sorted(r["page_num"] for r in pages.collect()) == [4, 5, 6]
    assert resume.plan_pages(docs).count() == 10


def test_labels(spark):
    rows = [("d", 0, k, label, content, box) for k, (label, content, box) in enumerate([("Text", "a", [0, 0, 2, 2]), ("Text", "b", [2, 0, 1, 2]), ("Image", "<img/>", [0, 0, 3, 3]), ("Blank-Page", "", [0, 0, 1, 1]), ("Page-Header", "h", [0, 0, 1, 1]), ("New", "n", [0, 0, 1, 1])])]
    df = spark.createDataFrame(rows, "doc_id string, page_num int, block_idx int, label string, content string, bbox array<int>")
    assert {r["caption"] for r in labels.numbered(df.union(df)).collect()} == {"Text #1", "Text #2", "Image #1", "Blank-Page #1", "Page-Header #1", "New #1"}
    assert labels.select_blocks(df, images=False).count() == 3 and labels.select_blocks(df, headers_footers=True).count() == 5
    assert labels.croppable(df).count() == 1 and labels.drawable(df).count() == 5
    colours = {r["label"]: r["color"] for r in labels.coloured(df).collect()}
    assert colours["Text"] == "#45B7D1" and colours["New"] == "#FF00FF"
    assert labels.overlay(df).where("caption = 'Text #2'").count() == 0


def test_contents(spark):
    text = "intro\n# Table of Contents\n## 1\njunk\n# **First** one\ntext\n```\n# code\n```\n## Part\n### Part\n#### deep\n# First one\n  ```\n# open code"
    df = spark.createDataFrame([("a", text), ("b", "# Table of Contents\nno end"), ("c", None), ("d", ""), ("e", "# TABLE OF contents\n# **\n# **")], "doc_id string, text string")
    found = toc.headings(df.where("doc_id = 'a'")).orderBy("position").collect()
    assert [(r["level"], r["heading"], r["anchor"]) for r in found] == [
        (1, "Table of Contents", "table-of-contents"), (2, "1", "1"), (1, "First one", "first-one"), (2, "Part", "part"), (3, "Part", "part-1"), (1, "First one", "first-one-1"),
    ]
    got = {r["doc_id"]: r["rewritten"] for r in toc.rewrite(df).collect()}
    assert set(got) == {"a", "e"}
    assert got["a"].startswith("intro\n# Table of Contents\n\n- [First one](#first-one)\n  - [Part](#part)\n    - [Part](#part-1)\n- [First one](#first-one-1)\n\n# **First** one\ntext\n")
    assert "junk" not in got["a"] and got["e"] == "# Table of Contents\n\n_(no headings found)_\n# **\n# **"


def test_progress(spark):
    start = datetime(2024, 1, 1)
    done = spark.createDataFrame([("a", k, start + timedelta(minutes=50 * k), k == 3) for k in range(5)], "doc_id string, page_num int, finished_at timestamp, error boolean")
    totals = spark.createDataFrame([("a", 7, 2)], "doc_id string, total int, already_done int")
    got = progress.page_progress(done, totals, every=3).orderBy("page_num").collect()
    assert [(r["n_done"], r["reported"]) for r in got] == [(3, True), (4, False), (5, False), (6, True), (7, True)]
    books = spark.createDataFrame([("a", 1, 1, "s")], "doc_id string, book_no int, n_books int, stem string")
    lines = [r["line"] for r in progress.lines(progress.page_progress(done, totals, 3), books).orderBy("page_num").collect()]
    assert lines[1] == "  Book # 1 of 1, s, Page # 4 of 7 ERR"


class Fake:
    """Fails, loops or answers by the page number, and by how often it was asked."""

    def __init__(self):
        self.asked = []

    def generate(self, requests, temperature, top_p):
        self.asked.append((requests["page_num"].tolist(), temperature, top_p))
        rows = []
        for page in requests["page_num"]:
            tries = sum(page in asked for asked, _, _ in self.asked)
            if page == 0 or (page == 1 and tries > 1):
                rows.append((f'<div data-label="Text" data-bbox="0 0 1000 1000">page {page}</div>', 5, False, None))
            elif page == 1:
                rows.append(("ab" * 100, 5, False, None))
            else:
                rows.append((None, 0, True, "auth" if page == 2 else "timeout"))
        return pd.DataFrame(rows, columns=["raw", "token_count", "error", "error_kind"])


def test_retries_by_rule():
    fake, waits = Fake(), []
    got = model.answer_batch(fake, pd.DataFrame({"page_num": [3, 2, 1, 0]}), 2, 2, 0.0, 0.1, wait=waits.append)
    assert got["attempts"].tolist() == [3, 1, 2, 1] and got["error"].tolist() == [True, True, False, False]
    assert fake.asked == [([3, 2, 1, 0], 0.0, 0.1), ([3, 1], 0.2, 0.95), ([3], 0.4, 0.95)] and waits == [2, 4]
    assert not is_loop(got["raw"][2])
    compat = model.answer_batch(Fake(), pd.DataFrame({"page_num": [2]}), 2, 1, 0.0, 0.1, honour_class=False, wait=waits.append)
    assert compat["attempts"].tolist() == [2]


def test_a_model_that_raises_gives_error_rows():
    class Broken:
        def generate(self, requests, temperature, top_p):
            raise RuntimeError("x")

    got = model.answer_batch(Broken(), pd.DataFrame({"page_num": [1]}), 0, 0, 0.0, 0.1)
    assert got["error"].tolist() == [True] and got["raw"].tolist() == [""]


class Steady:
    def generate(self, requests, temperature, top_p):
        rows = [(None, 0, True, "auth") if p == 2 else (f'<div data-label="Text">page {p}</div>', 7, False, None) for p in requests["page_num"]]
        return pd.DataFrame(rows, columns=["raw", "token_count", "error", "error_kind"])


def test_a_run_does_what_is_pending(spark):
    docs = spark.createDataFrame([("a", "A", 4)], "doc_id string, stem string, total_pages int")
    pages = spark.createDataFrame([("a", k, 100, 200) for k in range(3)], "doc_id string, page_num int, width int, height int")
    done = parse.parse_pages(spark.createDataFrame([("a", 0, '<div data-label="Text">old</div>')], "doc_id string, page_num int, raw string"))
    left = pipeline.run(docs, pages, done, Steady)
    got = {r["page_num"]: r for r in left.artifacts.collect()}
    assert got[0]["markdown"] == "old" and got[1]["markdown"] == "page 1" and got[1]["chunks"][0]["chunk_id"] == "A/0001/000"
    assert got[2]["error"] and got[2]["error_message"].startswith("auth") and got[3]["error"] and len(got) == 4
    stats = left.statistics.first().asDict()
    assert stats == {"books": 1, "pages_processed": 4, "pages_pending": 0, "pages_failed": 2} and pipeline.exit_code(left.statistics) == 1
    shown = pipeline.one_page(pages.where("page_num = 1"), Steady).first()
    assert shown["blocks"][0]["color"] == "#45B7D1" and shown["markdown"] == "page 1"


def test_parsing_never_ends_a_run(spark):
    rows = [("a", 0, None, None, None), ("a", 1, "", 5, False), ("a", 2, "<div>x", None, True), ("a", None, "<div data-label='Text'>y</div>", None, None)]
    got = parse.parse_pages(spark.createDataFrame(rows, "doc_id string, page_num int, raw string, token_count int, error boolean")).collect()
    by = {r["page_num"]: r for r in got}
    assert by[0]["error"] and by[0]["error_message"] == "ValueError: empty reply" and by[1]["markdown"] == "" and not by[1]["error"]
    assert by[2]["error"] and by[None]["chunks"][0]["chunk_id"] == "_/000"


def test_parsed_pages_agree_with_the_table(spark, sf):
    table = spark.read.parquet(f"{sf}/page_artifacts.parquet").where("not coalesce(error, false)")
    raw = table.select("doc_id", "page_num", F.col("raw_html").alias("raw"), F.get("page_box", F.lit(2)).alias("width"), F.get("page_box", F.lit(3)).alias("height"))
    made = parse.parse_pages(raw.distinct()).select("doc_id", "page_num", "raw_html", F.col("html_filtered").alias("h"), F.col("markdown").alias("m"), F.size("chunks").alias("n"))
    both = table.distinct().join(made, ["doc_id", "page_num", "raw_html"])
    row = both.agg(F.avg((F.col("h") == F.col("html_filtered")).cast("int")).alias("html"), F.avg((F.col("n") == F.size("chunks")).cast("int")).alias("chunks"), F.avg((F.col("m") == F.col("markdown")).cast("int")).alias("md")).first()
    # The table's fields carry planted dirt of their own.
    assert row["html"] > 0.93 and row["chunks"] > 0.97 and row["md"] > 0.84


def test_images_are_inlined():
    html = '<p>a</p><img alt="t" src="x.webp"/><img src="y.webp"/>'
    assert parse.inlined(html, {"x.webp": "data:x", "y.webp": "data:y"}) == (
        '<p>a</p><div class="image-wrapper"><div class="image-alt-text">t</div><div class="image-container-wrapper"><img alt="t" src="data:x"/></div></div><img src="data:y"/>'
    )


def test_prompts(spark):
    df = spark.createDataFrame([("own", "x"), ("", "ocr"), (None, "ocr")], "p string, k string")
    assert [r[0] for r in df.select(model.prompt(F.col("p"), F.col("k"), {"ocr": "read"})).collect()] == ["own", "read", "read"]
    with pytest.raises(Exception, match="no prompt"):
        spark.createDataFrame([(None, "x")], "p string, k string").select(model.prompt(F.col("p"), F.col("k"), {"ocr": "read"})).collect()
    body = df.limit(1).select(model.message(F.col("p"), F.lit("data:"))).first()[0]
    assert body["content"][0]["image_url"]["url"] == "data:" and body["content"][1]["text"] == "own"
