from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirework import config
from quirework.functions import geometry, ranges, repeats, serving, text


@pytest.mark.parametrize(
    ("spec", "pages"),
    [("1", [0]), ("1-5", [0, 1, 2, 3, 4]), ("1-3,7,9-10", [0, 1, 2, 6, 8, 9]), ("3,1,2,1-2", [0, 1, 2]), (" 1 - 3 , 5 ", [0, 1, 2, 4])]
    + [(bad, None) for bad in ("", "  ", None, "1,", "5-", "1--5", "abc", "1-abc", "0", "-1", "5-1", "0-3", "1-2-3", ",")],
)
def test_page_range(spark, spec, pages):
    if pages is None:
        with pytest.raises(ValueError):
            ranges.parse_page_range(spec)
    else:
        assert ranges.parse_page_range(spec) == pages
    row = spark.createDataFrame([(spec,)], "s string").select(ranges.page_range(F.col("s")).alias("p")).first()
    assert row["p"] == pages


def test_page_range_or_fail(spark):
    with pytest.raises(Exception, match="not a page range"):
        spark.createDataFrame([("x",)], "s string").select(ranges.page_range_or_fail(F.col("s"))).collect()


def test_selected_pages(spark):
    df = spark.createDataFrame([([4, 5, 6], 10), ([4, 5, 6], 6), (None, 3), (None, 0)], "p array<int>, n int")
    got = [tuple(r) for r in df.select(ranges.selected(F.col("p"), F.col("n")).alias("s"), ranges.count_selected(F.col("p"), F.col("n")).alias("k")).collect()]
    assert got == [([4, 5, 6], 3), ([4, 5], 2), ([0, 1, 2], 3), ([], 0)]


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")])
    return df.select(column.alias("r")).first()["r"]


def test_paths(spark):
    rows = spark.createDataFrame([("/a/b.PDF",), ("c.tar.gz",), (".hidden",), ("/x/no",), ("d.e/f",)], "p string")
    got = [tuple(r) for r in rows.select(text.file_name(F.col("p")), text.stem(F.col("p")), text.suffix(F.col("p"))).collect()]
    assert got == [("b.PDF", "b", ".pdf"), ("c.tar.gz", "c.tar", ".gz"), (".hidden", ".hidden", ""), ("no", "no", ""), ("f", "f", "")]


def test_text_functions(spark):
    c = F.col
    assert one(spark, text.chunk_id(c("s"), c("p"), F.lit(3)), s="My Book é", p=42) == "My-Book-é/0042/003"
    assert one(spark, text.chunk_id(c("s"), F.lit(None).cast("int"), F.lit(0)), s="a") == "_/000"
    assert one(spark, text.slug(c("h")), h="  What's *new*, Ünïcode_x? ") == "whats-new-ünïcode-x"
    assert one(spark, text.slug(c("h")), h="?!") == "section"
    assert one(spark, text.clean_heading(c("h")), h=" **A** _b_ __c__ ") == "A b c"
    assert one(spark, text.heading_level(c("h")), h="## x ") == 2 and one(spark, text.heading_level(c("h")), h="#### x") is None
    assert one(spark, text.page_artifact_name(c("p")), p=7) == "0007.json"
    assert one(spark, text.mime_type(c("f")), f="jpeg") == "image/jpeg" and one(spark, text.mime_type(c("f")), f="WEBP") == "image/webp"
    assert one(spark, text.data_url(c("b"), F.lit("PNG")), b=b"abc") == "data:image/png;base64,YWJj"
    assert one(spark, text.is_pdf(c("b")), b=b"%PDF-1.7") is True and one(spark, text.is_pdf(c("b")), b=b"x") is False
    images = F.create_map(F.lit("a.b.webp"), F.lit("data:$1\\x"))
    assert one(spark, text.embed_images(c("m"), images), m='![x](a.b.webp "t") ![y](aXb.webp)') == "![x](data:$1\\x) ![y](aXb.webp)"
    assert one(spark, text.is_page_artifact(c("n")), n="0001.json") and not one(spark, text.is_page_artifact(c("n")), n="0001.json.tmp")
    assert one(spark, text.page_list(F.array(F.lit(0), F.lit(4)))) == "1,5"


def slow_fit(width: int, height: int) -> tuple[int, int]:
    """The sizes by one image at a time."""
    if width <= 0 or height <= 0:
        return width, height
    most, least, g = 3072 * 2048, 1792 * 28, 28
    px = width * height
    k = (most / px) ** 0.5 if px > most else (least / px) ** 0.5 if px < least else 1.0
    w, h = max(1, round(width * k / g)), max(1, round(height * k / g))
    while w * h * g * g > most and (w, h) != (1, 1):
        if w == 1 or (h > 1 and abs(w / (h - 1) - width / height) <= abs((w - 1) / h - width / height)):
            h -= 1
        else:
            w -= 1
    return w * g, h * g


def test_fitted_sizes_against_one_by_one():
    rng = random.Random(1)
    sizes = [(rng.randint(1, 9000), rng.randint(1, 9000)) for _ in range(800)] + [(1, 200_000), (200_000, 1), (0, 5), (3072, 2048), (28, 28)]
    w, h = geometry.fitted_sizes(np.array([s[0] for s in sizes]), np.array([s[1] for s in sizes]))
    assert list(zip(w.tolist(), h.tolist())) == [slow_fit(*s) for s in sizes]


def test_geometry_columns(spark):
    df = spark.createDataFrame([(800, 600), (200, 400), (None, 3), (0, 0)], "w int, h int")
    got = df.select(geometry.fit_to_grid("w", "h").alias("f"), geometry.upscaled_size(F.col("w"), F.col("h")).alias("u"), geometry.render_scale(F.col("w"), F.col("h")).alias("r")).collect()
    assert tuple(got[0]["f"]) == slow_fit(800, 600) and got[2]["f"]["width"] is None
    assert tuple(got[1]["u"]) == (1536, 3072) and tuple(got[3]["u"]) == (0, 0)
    assert got[0]["r"] == pytest.approx(max(1024 / 600 * 72, 192) / 72) and got[3]["r"] is None
    boxes = spark.createDataFrame([("1 2 3 4",), ("1_0 2 3 4",), (" 1 2 3 4",), (None,), ("+1 -2 3 4",)], "s string")
    assert [r[0] for r in boxes.select(geometry.parse_bbox(F.col("s"))).collect()] == [[1, 2, 3, 4], None, None, None, [1, -2, 3, 4]]


def slow_loop(s: str) -> bool:
    for unit in range(1, 251):
        if unit > len(s):
            break
        end, n, at = s[-unit:], 0, len(s) - unit
        while at >= 0 and s[at : at + unit] == end:
            n, at = n + 1, at - unit
        if n > int(4 * (1 + 3 / unit)):
            return True
    return False


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab ", max_size=30), st.text(alphabet="abc", min_size=1, max_size=6), st.integers(0, 20), st.text(alphabet="xyz", max_size=3))
def test_loops_against_counting(head, unit, times, tail):
    s = head + unit * times + tail
    assert repeats.ends_in_loop(s) == slow_loop(s)
    assert repeats.is_loop(s) == (slow_loop(s) or (len(s) > 50 and slow_loop(s[:-50])))


def test_loops(spark):
    noise = "the quick brown fox jumps over a lazy dog, and so"
    cases = {"x" * 16: False, "x" * 17: True, "abc" * 50: True, "a plain sentence.": False, "abc" * 50 + noise: True, "": False, None: False, "q" + "ab" * 2000: True}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", repeats.is_degenerate(F.col("t")).alias("d")).collect()
    assert {r["t"]: r["d"] for r in rows} == cases
    assert repeats.is_loop("abc" * 50 + "z" * 10, cut_from_end=10)


def test_serving(spark):
    df = spark.createDataFrame([(g, v) for g, v in serving.VRAM_GB.items()], "g string, v int")
    got = {r["g"]: (r["a"], r["b"]) for r in df.select("g", serving.batched_tokens(F.col("v")).alias("a"), serving.sequences(F.col("v")).alias("b")).collect()}
    assert got["h100"] == (8192, 64) and got["l40s"] == (4096, 32) and got["l4"] == (2048, 16) and got["t4"] == (1024, 8)
    assert one(spark, serving.vram(F.col("g")), g="none") is None
    kinds = [("AuthenticationError", None, "auth", False), ("RateLimitError", None, "rate_limit", True), ("APITimeoutError", None, "timeout", True), ("APIConnectionError", None, "connection", True), ("APIStatusError", 503, "http_503", True), ("APIStatusError", 404, "http_404", False), ("X", None, "unknown", True)]
    rows = spark.createDataFrame(kinds, "k string, s int, c string, r boolean").withColumn("e", serving.error_class(F.col("k"), F.col("s"))).withColumn("ok", serving.is_retryable(F.col("e"))).collect()
    assert all(r["e"] == r["c"] and r["ok"] == r["r"] for r in rows)
    for retries, (t, p) in enumerate([(0.0, 0.1), (0.2, 0.95), (0.4, 0.95), (0.6, 0.95), (0.8, 0.95), (0.8, 0.95)]):
        assert one(spark, serving.retry_temperature(F.lit(0.0), F.col("k")), k=retries) == pytest.approx(t)
        assert one(spark, serving.retry_top_p(F.col("k")), k=retries) == pytest.approx(p)
    for loop, failed, k in itertools.product((True, False), (True, False), (0, 2, 3)):
        got = one(spark, serving.should_retry(F.col("l"), F.col("f"), F.col("k"), 3, 2), l=loop, f=failed, k=k)
        assert got == ((loop and k < 3) or (failed and k < 2))


def test_settings(tmp_path):
    (tmp_path / "local.env").write_text("QUIREWORK_IMAGE_DPI=300\n")
    assert config.load(tmp_path, {}).image_dpi == 300
    (tmp_path / ".env").write_text("# c\nQUIREWORK_IMAGE_DPI='150'\nOTHER=1\n")
    assert config.load(tmp_path, {}).image_dpi == 150
    assert config.load(tmp_path, {"QUIREWORK_IMAGE_DPI": "96"}).image_dpi == 96
    assert config.load(tmp_path / "none", {}) == config.Settings()
