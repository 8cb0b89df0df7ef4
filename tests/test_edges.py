from __future__ import annotations

import builtins
import http.server
import importlib
import json
import shutil
import sys
import threading
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quirework import config
from quirework.operators import assemble, model, service
from quirework.plans import pipeline
from quirework.plans import queries as core
from quirework.sinks import outputs
from quirework.sources import files, pages
from quirework.streaming import completion
from tests.test_operators import ARTIFACT, Steady, artifact


def touch(path: Path) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"x")


@pytest.fixture()
def tree(tmp_path):
    for name in ("a.pdf", "B.PNG", "n.txt", "sub/c.jpg", "sub/deep/d.tiff", "out/out.md", "out/e_0_img.webp", "done/chunks.jsonl", "done/f.webp", "work/.partial/pages/0000.json", "work/.partial/g.png", "work/h.webp"):
        touch(tmp_path / name)
    return tmp_path


def names(df):
    return sorted(Path(r["path"]).name for r in df.collect())


def test_discovery(spark, tree):
    assert names(files.discover(spark, str(tree))) == ["B.PNG", "a.pdf"]
    assert names(files.discover(spark, str(tree), recursive=True)) == ["B.PNG", "a.pdf", "c.jpg", "d.tiff"]
    assert names(files.discover(spark, str(tree / "*.pdf"))) == ["a.pdf"]
    assert names(files.discover(spark, str(tree / "out" / "*.webp"))) == ["e_0_img.webp"]  # a pattern may name outputs
    one = files.discover(spark, str(tree / "a.pdf")).first()
    assert one["stem"] == "a" and one["length"] == 1
    with pytest.raises(ValueError, match="unsupported"):
        files.discover(spark, str(tree / "n.txt"))
    with pytest.raises(ValueError, match="exist"):
        files.discover(spark, str(tree / "none"))


def test_uploads():
    assert files.check_upload("x.PDF", "3") == 3
    for name, number in ((None, 0), ("", 0), ("x.txt", 0), ("x.pdf", "a"), ("x.pdf", -1)):
        with pytest.raises(ValueError):
            files.check_upload(name, number)


def test_markdown_files(spark, tmp_path):
    (tmp_path / "a.md").write_text("# x\n\ny\n")
    assert files.read_markdown(spark, str(tmp_path / "a.md")).first()["text"] == "# x\n\ny\n"


class Three:
    """A renderer of three pages, the last of which fails in files that say so."""

    def count(self, content):
        if content.endswith(b"bad"):
            raise ValueError("broken")
        return 3

    def render(self, content, wanted):
        for p in wanted:
            if p == 2 and content.endswith(b"bad"):
                raise ValueError("broken")
            if p < 3:
                yield p, b"img", 10 + p, 20


def test_pages_are_rendered_one_by_one(spark):
    df = spark.createDataFrame([("a", b"%PDF-good"), ("b", b"%PDF-bad"), ("c", b"png")], "doc_id string, content binary")
    assert {r["doc_id"]: r["total_pages"] for r in pages.count_pages(df, Three).collect()} == {"a": 3, "b": None, "c": 1}
    wanted = spark.createDataFrame([("a", 2), ("a", 0), ("b", 1), ("b", 2), ("c", 5)], "doc_id string, page_num int")
    got = {(r["doc_id"], r["page_num"]): (r["error"], r["width"]) for r in pages.render_pages(df, wanted, Three).collect()}
    assert got == {("a", 0): (False, 10), ("a", 2): (False, 12), ("b", 1): (False, 11), ("b", 2): (True, None), ("c", 5): (True, None)}


def test_command_line(spark, tmp_path, capsys):
    from quirework.__main__ import main

    for name in ("a.pdf", "b.PDF", "n.txt"):
        (tmp_path / "in" / name).parent.mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_bytes(b"%PDF-good")
    run = [str(tmp_path / "in"), str(tmp_path / "out"), "--model", "tests.test_operators:Steady", "--renderer", "tests.test_edges:Three"]
    assert main([*run, "--page-range", "1-2", "--files", "--log-every", "2"]) == 0
    artifacts = str(tmp_path / "out/artifacts")
    assert spark.read.parquet(artifacts).count() == 4
    said = capsys.readouterr().out
    assert "  Book # 1 of 2, a, Page # " in said and "  Book # 2 of 2, b, Page # " in said and said.count("Page #") == 2 and "2 documents: 4 pages done" in said
    assert (tmp_path / "out/files/a/a.md").read_text() == "page 0\n\npage 1" and (tmp_path / "out/files/b/b.html").exists()
    assert '"file_name":"a.pdf"' in (tmp_path / "out/files/a/a_metadata.json").read_text() and (tmp_path / "out/files/a/chunks.jsonl").read_text().count("\n") == 2
    # A changed source is read again, the other one goes on; the third pages fail in the model.
    (tmp_path / "in/b.PDF").write_bytes(b"%PDF-other-good")
    assert main([*run, "--slice-pages", "4", "--fail-fast"]) == 1
    rows = spark.read.parquet(artifacts).where("run_no = 2")
    assert rows.count() == 4 and "6 pages done" in (said := capsys.readouterr().out) and "stopped" in said
    texts = [r["markdown"] for r in spark.read.parquet(str(tmp_path / "out/documents/markdown")).collect()]
    assert texts == ["page 0\n\npage 1\n\n"] * 2 and spark.read.parquet(str(tmp_path / "out/states")).count() == 4
    assert main([str(tmp_path / "none"), *run[1:]]) == 2 and main([*run, "--page-range", "0"]) == 2 and main([*run[:2], *run[4:]]) == 2


def test_sinks(spark, tmp_path):
    target = tmp_path / "x" / "a.md"
    outputs.write_text(target, "é")
    assert target.read_text(encoding="utf-8") == "é" and not target.with_name("a.md.tmp").exists()
    assert not outputs.rewrite_file(target, "new") and target.read_text() == "é"
    assert outputs.rewrite_file(target, "new", apply=True) and target.read_text() == "new" and (tmp_path / "x" / "a.md.bak").read_text(encoding="utf-8") == "é"
    fails = iter([OSError(), OSError()])

    def remove(folder):
        error = next(fails, None)
        if error:
            raise error
        shutil.rmtree(folder)

    assert outputs.purge(tmp_path / "x", (0, 0, 0), remove) and outputs.purge(tmp_path / "x", (0,))
    (tmp_path / "y").mkdir()
    assert not outputs.purge(tmp_path / "y", (0, 0), lambda _: (_ for _ in ()).throw(OSError()))
    df = spark.createDataFrame([artifact("a", 1, "q"), artifact("a", 0, "p")], ARTIFACT)
    outputs.append_artifacts(df.limit(1), str(tmp_path / "art"))
    outputs.append_artifacts(df.where("page_num = 0"), str(tmp_path / "art"))
    assert spark.read.parquet(str(tmp_path / "art")).count() == 2
    outputs.write_documents(df, spark.createDataFrame([("a", "a.pdf")], "doc_id string, file_name string"), str(tmp_path / "docs"))
    assert spark.read.parquet(str(tmp_path / "docs/markdown")).first()["markdown"] == "p\n\nq"
    assert [r["content"] for r in spark.read.json(str(tmp_path / "docs/chunks")).collect()] == ["p", "q"]
    outputs.export_files(assemble.assemble(df).withColumn("stem", F.lit("a")), str(tmp_path / "files"), "markdown", ".md")
    assert (tmp_path / "files/a/a.md").read_text() == "p\n\nq"
    page = spark.createDataFrame([("u", 1, 2, "h", "m")], "image_url string, width int, height int, html string, markdown string").withColumn("blocks", F.array())
    assert outputs.response(page).first()["body"].startswith('{"image_base64":"u","image_width":1')


def test_a_run_that_dies_keeps_what_was_answered(spark, tmp_path):
    docs = spark.createDataFrame([("a", "A", 40)], "doc_id string, stem string, total_pages int")
    all_pages = spark.createDataFrame([("a", k, 100, 200) for k in range(40)], "doc_id string, page_num int, width int, height int")
    table, asked = str(tmp_path / "artifacts"), []

    def pages_of(keys):
        if len(asked) == 2:
            raise KeyboardInterrupt  # the run ends in its third slice
        asked.append(keys.count())
        return all_pages.join(keys, ["doc_id", "page_num"], "left_semi")

    with pytest.raises(KeyboardInterrupt):
        list(pipeline.run_slices(docs, pages_of, table, Steady, slice_pages=10))
    kept = spark.read.parquet(table)
    assert kept.count() == sum(asked) and 0 < sum(asked) < 40
    again = []

    def rest(keys):
        again.append(keys.count())
        return all_pages.join(keys, ["doc_id", "page_num"], "left_semi")

    slices = list(pipeline.run_slices(docs, rest, table, Steady, slice_pages=10, run_no=2))
    assert sum(again) == 40 - sum(asked) and len(slices) == slices[0].total
    done = spark.read.parquet(table)
    assert done.count() == 40 == done.select("page_num").distinct().count()


class _Service(http.server.BaseHTTPRequestHandler):
    seen: list[dict] = []

    def do_POST(self):  # noqa: N802
        asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        self.seen.append({"path": self.path, "auth": self.headers["Authorization"], **asked})
        text = asked["messages"][0]["content"][1]["text"]
        if text.isdigit():
            self.send_response(int(text))
            self.end_headers()
            return
        body = {"choices": [{"message": {"content": f"read: {text}"}}], "usage": {"completion_tokens": 3}} if text != "odd" else {"choices": []}
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *args):
        pass


def test_a_service_answers_in_order_and_errors_are_rows(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    settings = config.Settings(api_base=f"http://127.0.0.1:{server.server_port}/v1", api_key="k", model_name="m", client_timeout=20)
    try:
        made = service.service_factory(settings, "usual", 99)()
        prompts = ["one", None, "401", "429", "404", "503", "odd", "last"]
        got = made.generate(pd.DataFrame({"image": [b"\x89PNG\r\n\x1a\nx"] * 8, "prompt": prompts}), 0.2, 0.95)
        assert got["raw"].tolist() == ["read: one", "read: usual", "", "", "", "", "", "read: last"]
        assert got["error_kind"].tolist() == [None, None, "auth", "rate_limit", "http_404", "http_503", "unknown", None] and got["token_count"].sum() == 9
        first = next(s for s in _Service.seen if s["messages"][0]["content"][1]["text"] == "one")
        assert first["path"] == "/v1/chat/completions" and first["auth"] == "Bearer k" and first["max_tokens"] == 99 and first["temperature"] == 0.2 and first["model"] == "m"
        assert first["messages"][0]["content"][0]["image_url"]["url"].startswith("data:image/png;base64,")
        pages_in = spark.createDataFrame([("a", k, b"img") for k in range(6)], "doc_id string, page_num int, image binary")
        rows = model.generate(pages_in, service.service_factory(settings, "usual"), max_retries=0).collect()
        assert {r["raw"] for r in rows} == {"read: usual"} and len(rows) == 6
    finally:
        server.shutdown()
    gone = service.ServiceModel("http://127.0.0.1:9", "k", "m", "p", 1, 2.0).generate(pd.DataFrame({"image": [b"x"]}), 0.0, 0.1)
    assert gone["error_kind"].tolist() == ["connection"]


def test_models_of_different_calls_differ(spark):
    df = spark.createDataFrame([(0,)], "page_num int").coalesce(1)
    for text in ("first", "second"):
        made = model.generate(df, lambda text=text: type("M", (), {"generate": lambda self, r, t, p: pd.DataFrame({"raw": [text] * len(r), "token_count": 1, "error": False, "error_kind": None})})(), max_retries=0)
        assert made.first()["raw"] == text


def test_a_stream_emits_each_document_once_and_resumes(spark, tmp_path):
    schema = "doc_id string, page_num int, token_count int, error boolean"
    far = completion.PART_PAGES
    expected = spark.createDataFrame([("a", 0), ("a", 1), ("a", 2), ("b", 0), ("c", 0), ("c", far), ("c", far), ("d", 0), ("d", 1), ("d", None)], "doc_id string, page_num int")
    out = []

    def batch(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = completion.read_artifacts(spark, str(tmp_path / "in"), schema)
        completion.drain(completion.complete_parts(stream, expected), lambda df, _: out.extend(tuple(r) for r in df.collect()), str(tmp_path / "cp"), 120)
        done = spark.createDataFrame(out, completion.PARTS_SCHEMA)
        return sorted(map(tuple, completion.complete_documents(done, expected).collect()))

    assert batch([("a", 2, 5, False), ("a", 0, None, None), ("z", 0, 1, False), ("d", 7, 1, False), ("d", 8, 1, False), ("c", 0, 1, None)]) == []  # pages 7 and 8 of d aren't those it expects
    assert out == [("c", 0, 1, 0, 1)]
    assert batch([("b", 0, 4, True), ("a", 0, 9, False)]) == [("b", 1, 1, 4)]
    assert batch([("a", 1, 7, False), ("b", 0, 4, True), ("c", far, 2, None), ("d", 0, 1, False)]) == [("a", 3, 0, 12), ("b", 1, 1, 4), ("c", 2, 0, 3)]
    assert len(batch([("a", 1, 7, False), ("c", far, 2, None)])) == 3 and len(out) == 4


def _norm(value):
    if value is None or value != value:
        return None
    if hasattr(value, "item"):
        value = value.item()
    return value if isinstance(value, bool) else round(value, 6) if isinstance(value, float) else str(value)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_queries_agree_with_sql(spark, sf, duck, name):
    df = core.queries()[name](spark, sf)
    ours = sorted((tuple(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=str)
    if name not in core.oracle_sql():
        return
    result = duck.execute(core.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    theirs = sorted((tuple(_norm(r[i]) for i in order) for r in result.fetchall()), key=str)
    assert sorted(df.columns) == sorted(columns)
    assert ours == theirs


def test_the_entry_needs_no_text_operators(spark, sf, monkeypatch):
    for name in [m for m in sys.modules if m.startswith("quirework.llm") or m == "__spark_entry__"]:
        monkeypatch.delitem(sys.modules, name)
    real = importlib.import_module

    def blocked(name, *args):
        if name.startswith("quirework.llm"):
            raise ModuleNotFoundError(name=name)
        return real(name, *args)

    monkeypatch.setattr(importlib, "import_module", blocked)
    entry = real("__spark_entry__")
    found = entry.queries()
    assert found and set(entry.oracle_sql()) <= set(found) and not any(n[0] == "p" and n[1].isdigit() for n in found)
    assert entry.entry(spark).count() > 0
    monkeypatch.delitem(sys.modules, "__spark_entry__")


def test_nothing_else_imports_the_text_operators():
    root = Path(builtins.__import__("quirework").__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "quirework.llm" not in path.read_text(encoding="utf-8"), path
