from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quirework.html.layout import Page, chunk_id, image_ref, pixel_bbox
from quirework.html.markdown import to_markdown
from quirework.html.prompt import ALLOWED_ATTRIBUTES, ALLOWED_TAGS
from quirework.html.sanitize import safe_style, safe_url, sanitize_html
from quirework.html.tree import Node, parse, serialize


def div(content: str, label: str | None = "Text", bbox: str | None = "0 0 500 500") -> str:
    attrs = (f' data-bbox="{bbox}"' if bbox is not None else "") + (f' data-label="{label}"' if label else "")
    return f"<div{attrs}>{content}</div>"


def markdown(*divs: str, **options: bool) -> str:
    return to_markdown(Page("".join(divs)).flow(**options))


@pytest.mark.parametrize(
    ("html", "clean"),
    [
        ("", ""), (None, None), ("plain", "plain"),
        ("<p>a<script>alert(1)</script>b</p>", "<p>ab</p>"), ("<iframe src='x'>in</iframe>after", "after"), ("<noscript><p>x</p></noscript>y", "y"),
        ('<p onclick="x()">a</p>', "<p>a</p>"), ('<a href="javascript:x()">a</a>', "<a>a</a>"), ('<a href=" java\nscript:x()">a</a>', "<a>a</a>"),
        ('<a href="https://x.org/?a=1&amp;b=2">a</a>', '<a href="https://x.org/?a=1&amp;b=2">a</a>'), ("a<!-- c -->b", "ab"), ("<font size=2>a</font>", "a"),
        ('<p style="color: red; position: fixed">a</p>', '<p style="color: red;">a</p>'), ("1 < 2 & 3", "1 &lt; 2 &amp; 3"), ("<ul><li>a<li>b</ul>", "<ul><li>a</li><li>b</li></ul>"),
        ("<p>a<p>b", "<p>a</p><p>b</p>"), ("<table><tr><td>a<td>b<tr><td>c</table>", "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>"),
    ],
)
def test_sanitize(html, clean):
    assert sanitize_html(html) == clean


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="<>/ab=\"'&;! -ps", max_size=60) | st.lists(st.sampled_from(["<p>", "</p>", "<b>", "<script>", "</script>", "<div>", "</div>", "<x y=1>", "<li>", "<td>", "a", "&lt;", "<!--", "-->", "<img src=z>"]), max_size=15).map("".join))
def test_sanitizing_twice_changes_nothing_and_keeps_to_the_allowlist(html):
    once = sanitize_html(html)
    assert sanitize_html(once) == once
    for node in parse(once or "").elements():
        assert node.tag in ALLOWED_TAGS
        assert set(node.attrs) <= set(ALLOWED_ATTRIBUTES) | {"src"}


def test_urls_and_styles():
    assert safe_url("page.html") and safe_url("mailto:a@b") and not safe_url("JAVASCRIPT:x") and not safe_url("vbscript:x")
    assert safe_style("background: url(x); color: red") == "color: red;"
    assert safe_style("color: url(javascript:x)") == ""


def test_tree_drops_stray_ends_and_closes_what_is_open():
    assert serialize(parse("</b><i>a</b></i><b>c")) == "<i>a</i><b>c</b>"
    assert serialize(parse('<img alt="a &quot;b&quot;"/>')) == '<img alt="a &quot;b&quot;"/>'


def test_flow_html():
    page = Page(div("bare text") + div("", "Blank-Page") + div("<p>h</p>", "Page-Header") + div('<img alt="x"/>', "Image") + div("<p>a<img/></p>"))
    assert serialize(page.flow()) == f'<p>bare text</p><img alt="x" src="{page.image_name(4)}"/><p>a</p>'
    assert "<p>h</p>" in serialize(page.flow(headers_footers=True))
    assert "<img" not in serialize(page.flow(images=False))
    assert page.image_name(4).endswith("_4_img.webp")
    without = Page(div("", "Figure"))
    assert serialize(without.flow()) == f'<img src="{without.image_name(1)}"/>'


def test_blocks_and_chunks():
    page = Page(div("", "Blank-Page") + div('<img alt="x"/>', "Image", "100 100 200 200") + div('<p data-bbox="1 2 3 4">t</p>', None, "1 2 3") + "loose <p>text</p>")
    blocks = page.blocks(800, 600)
    assert [(b.index, b.label, b.bbox) for b in blocks] == [(2, "Image", [80, 60, 160, 120]), (3, "block", [0, 0, 800, 600])]
    assert "data-bbox" not in blocks[1].content
    chunks = page.chunks(800, 600, "My Book", 1)
    assert [c["chunk_id"] for c in chunks] == ["My-Book/0001/000", "My-Book/0001/001"]
    assert chunks[0]["image_name"] == page.images(800, 600)[0][0] == page.image_name(2)
    assert chunks[0]["image_name"] in serialize(page.flow())


@pytest.mark.parametrize(
    ("raw", "box"),
    [("0 0 500 500", [0, 0, 500, 500]), ("a b c d", [0, 0, 1000, 1000]), (None, [0, 0, 1000, 1000]), ("1 2 3", [0, 0, 1000, 1000]), ("-5 0 2000 900", [0, 0, 1000, 900]), ("9 9 1 1", [9, 9, 1, 1]), ("1  2 3", [0, 0, 1000, 1000])],
)
def test_pixel_bbox(raw, box):
    assert pixel_bbox(raw, 1000, 1000) == box


def test_names():
    assert chunk_id("Cybersecurity & Data Science (2nd Ed.)", 1, 0) == "Cybersecurity-Data-Science-2nd-Ed/0001/000"
    assert chunk_id(None, 1, 2) == "_/002" and chunk_id("!!", 0, 0) == "_/0000/000" and chunk_id("é t", 0, 0) == "é-t/0000/000"
    assert image_ref('<img src="a.png"/><img src="b.webp"/>') == "b.webp" and image_ref("") is None


@pytest.mark.parametrize(
    ("html", "expected"),
    [
        ("<h2>A <b>b</b></h2><p>c</p>", "## A **b**\n\nc"), ("<p>a_b * c $5</p>", "a\\_b \\* c \\$5"), ("<p>x <math>a_1</math> y</p>", "x $a_1$ y"),
        ('<math display="block"> a = b </math>', "$$a = b$$"), ("<pre><code>a_b\n  c</code></pre>", "```\na_b\n  c\n```"),
        ("<ul><li>a<ul><li>b</li></ul></li><li>c</li></ul>", "- a\n  - b\n- c"), ("<ol><li>a</li><li>b</li></ol>", "1. a\n2. b"),
        ('<a href="u">x [1] (y)</a>', "[x \\[1\\] \\(y\\)](u)"), ("<p>a<br/>b</p>", "a\nb"), ("<p>H<sub>2</sub>O <sup>x</sup></p>", "H<sub>2</sub>O <sup>x</sup>"),
        ("<p>a</p><table><tr><td>1</td></tr></table><p>b</p>", "a\n\n<table><tr><td>1</td></tr></table>\n\nb"), ("<p>a   b\n c</p>", "a b\n c"), ("<p><del>a</del> <i>b</i></p>", "~~a~~ *b*"),
        ("<p><code>a_b</code></p>", "`a_b`"), ("<hr/>", "---"), ("", ""),
    ],
)
def test_markdown(html, expected):
    assert markdown(div(html, "Complex-Block")) == expected


def test_node_text():
    assert parse("<p>a<b>b</b>c</p>").text() == "abc"
    assert isinstance(parse("<p>").children[0], Node)
