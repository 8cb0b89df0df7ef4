from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quirework.llm import markup as mk

OWN_MARKDOWN = [
    "# A\n\ntext **b** *i* ~~d~~ [l](#note-3) `c_d`", "- a\n  - b\n\n1. x", "```\n<b>x</b> **y** &nbsp; {{t}}\n```", "$$\\frac{a}{b}$$ and $x_1 \\le 2$", "H<sub>2</sub>O<sup>3</sup>",
    "<table><caption>c</caption><tr><th colspan=\"2\">a &lt; b</th></tr></table>", "max\\_page\\_count is 3 \\* 4 for \\$45", "values <5 and >2, a -> b, B&K", "See note [1] and the set {a, b}.",
    "A | verso", "the motto 'festina lente'", "![Plate 4: x](a_1_img.webp)", "O=C=O\n\nC1=CC=CC=C1\n\nCC(=O)O", "1------------------------------------------------", "[illegible] 'a' ''", "", "x < y and read on",
]
FOREIGN_MARKDOWN = [
    "a <b>c</b>", 'x <div class="c">y</div>', "a <!-- x --> b", "a&nbsp;b", "it&#8217;s", "one &amp; two", "[[a, b]] c", "x [[File:p.png|thumb|y]]", "{{term|x}}", "''a b'' c", "'''a'''", "== Head ==\ntext",
    "{| class=\"g\"\n|-\n| a || b\n|}", "x \\cite{abc} y", "\\begin{quote} a \\end{quote}", "a \\item b", "\\[ E = \\alpha \\cdot v \\]", "[b]x[/b]", "[quote=N]y[/quote]", "\\*\\*by 9\\*\\* x", "\\_\\_Ostrev in\\_\\_ x",
    "a <EM>b</EM>", "x </p><p>y", "<br/>a", "__a b__ c",
]
OWN_HTML = [
    "<p>a <b>b</b> &lt; c &amp; d</p>", '<img alt="a" src="x.webp"/>', "<pre><code>&lt;b&gt; **x** &amp;nbsp; [[y]]</code></pre>", "<math>\\frac{a_1}{b}</math>", "<p>max_page_count is 3 * 4, $45 and $50, {a, b} [1]</p>",
    '<td align="right" colspan="2">1</td>', '<input type="checkbox" checked=""/>', "<chem>CC(=O)O</chem>", "<p>values &lt;5 and &gt;2</p>", "<p>x, y with x &lt; y and</p>", "<p>a -&gt; b</p>", "<code>a_b</code>",
]
FOREIGN_HTML = [
    "<p>a <font>b</font></p>", "<o:p>x</o:p>", "<script>go()</script>", '<p onclick="x">a</p>', "<p>a<!-- c --></p>", "<p>&amp;nbsp;x</p>", "<p>&nbsp;x</p>", "<p>&lt;b&gt;x&lt;/b&gt;</p>", "<p>**by 90 percent.** x</p>", "<p>***a b*** c</p>",
    "<p>__a in__ b</p>", "<p>a ~~b~~</p>", "<p>[x](#note)</p>", "<p>[[a]]</p>", "<p>\\cite{x}</p>", "<p>\\[ \\alpha \\]</p>", "<p>[b]x[/b]</p>", "<p># Head</p>", "<p>a `b` c</p>", "<h6>x</h6>", "<p>$x^2 + \\beta$</p>", "<p>== H ==</p>",
]


@pytest.mark.parametrize("value", OWN_MARKDOWN)
def test_own_markdown(value):
    assert mk.foreign_kinds(value, "markdown") == set() == mk.render_markdown(value)[1]


@pytest.mark.parametrize("value", FOREIGN_MARKDOWN)
def test_foreign_markdown(value):
    assert mk.foreign_kinds(value, "markdown") == mk.render_markdown(value)[1] != set()


@pytest.mark.parametrize("value", OWN_HTML)
def test_own_html(value):
    assert mk.foreign_kinds(value, "html_filtered") == set() == mk.render_html(value)[1]


@pytest.mark.parametrize("value", FOREIGN_HTML)
def test_foreign_html(value):
    assert mk.foreign_kinds(value, "content") == mk.render_html(value)[1] != set()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<b>", "a ", "b", "&amp;", "&lt;", "nbsp;", "**", "__", "[", "](", ")", "{", "}", "\\", "item ", "$", "'", "=", "\n", "|", "<font>", "`", "~", "#", " ", "*", "</b>", "x="]), max_size=14).map("".join))
def test_screening_loses_nothing(value):
    assert bool(mk.foreign_kinds(value, "content")) == bool(mk.render_html(value)[1])
    assert bool(mk.foreign_kinds(value, "markdown")) == bool(mk.render_markdown(value)[1])


def test_rendering():
    html = (
        '<h2>T</h2><p>a <i>b</i><br/>c</p><ul><li>x<ul><li>y</li></ul></li></ul><ol><li>p</li><li>q</li></ol><table><caption>C</caption><tr><th>name</th><th>n</th></tr><tr><td>ab</td><td>1</td></tr></table>'
        '<pre><code>k = 1\n  m</code></pre><p>E <math>a_1</math></p><math display="block">b</math><style>z{}</style><p style="display:none">hidden</p><font>seen</font><p><input type="checkbox" checked=""/> ok</p>'
    )
    text, kinds = mk.render_html(html)
    assert text == "## T\n\na b\nc\n\n- x\n  - y\n\n1. p\n2. q\n\nC\nname  n\nab    1\n\n```\nk = 1\n  m\n```\n\nE $a_1$\n\n$$\nb\n$$\nseen\n\n[x] ok"
    assert kinds == {"tag"}
    text, _ = mk.render_markdown("# T\n\n**a** <font>b</font>&nbsp;c [l](u) [[x|y]] \\cite{z} `k` $m_1$\n\n```\n**k**\n```\n\n<table><tr><td>1</td><td>2</td></tr></table>\n\n3 \\* 4")
    assert text == "# T\n\na b c l y z `k` $m_1$\n\n```\n**k**\n```\n\n1  2\n\n3 * 4"
    assert mk.render_html(None) == ("", set()) == mk.render_markdown("")


def test_very_long_values():
    assert mk.foreign_kinds("[b] __x [[ {{ '' \\( $" * 4000, "markdown") is not None
    assert mk.render_html("<div>" * 20_000 + "x")[0] == 'x'


def test_tables(spark):
    schema = "doc_id string, page_num int, markdown string, html_filtered string, chunks array<struct<content: string>>, kinds int, field string"
    rows = [("d", 1, "<b>x</b>", "<p>x</p>", [("<font>",), ("<font>",), (None,)], 1, "c"), ("d", 1, "<b>x</b>", "<p>x</p>", [("<font>",)], 1, "c"), ("e", 2, None, "", None, None, None), (None, None, "a&nbsp;b", None, [], 0, None)]
    found = mk.foreign_markup(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, found.select("doc_id", "page_num", "field").distinct().collect()), key=str) == [("d", 1, "content"), ("d", 1, "markdown"), (None, None, "markdown")]
    assert mk.foreign_markup(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([("<p>a</p>", 1, "old"), (None, 2, None)], "v string, _rendered int, clean_text string")
    out = mk.clean_text(df, "v", "html")
    assert out.columns == ["v", "_rendered", "clean_text", "foreign_kinds"]
    assert [tuple(r) for r in out.collect()] == [("<p>a</p>", 1, "a", []), (None, 2, None, [])]
    with pytest.raises(ValueError):
        mk.clean_text(df, "v", "wiki")


def test_visibility():
    for attr in ("hidden", 'hidden=""', 'style="display:none"', 'style="color: red; DISPLAY : none"', 'style="visibility:hidden"', 'style="visibility: collapse !important"'):
        assert mk.render_html(f"<p>a</p><p {attr}>secret <b>too</b></p><ul><li>x</li><li {attr}>secret</li></ul>")[0] == "a\n\n- x"
        assert mk.render_html(f"<table><tr><td>a</td><td {attr}>secret</td><td>b</td></tr><tr {attr}><td>secret</td></tr></table>")[0] == "a  b"
    assert mk.render_html('<p style="visibility:visible;display:block">seen</p>')[0] == "seen"


def test_cells_are_aligned_under_spans():
    html = '<table><tr><td rowspan="2">A</td><td>B</td></tr><tr><td>C</td></tr><tr><td colspan="2">D</td></tr></table>'
    assert mk.render_html(html)[0].split("\n") == ["A  B", "   C", "D"]
    wide = '<table><tr><td colspan="1001">a</td><td>b</td></tr><tr>' + "<td>c</td>" * 1002 + "</tr></table>"
    first, second = mk.render_html(wide)[0].split("\n")
    assert second.count("c") == 1002 and first.startswith("a") and first.index("b") == second.rindex("c")
    assert mk.render_html('<table><tr><td colspan="999999999" rowspan="x">a</td><td>b</td></tr></table>')[0] == "a  b"


def test_signs_far_apart():
    long = "word " * 5000
    for value in (f"[quote]{long}[/quote]", f"''{long}x''", f"\\*\\*{long}x\\*\\*", f"__{long}x__"):
        assert mk.foreign_kinds(value, "markdown"), value[:10]
    for value in (f"<p>**{long}x**</p>", f"<p>\\[{long}\\]</p>", f"<p>$x_1 {long}y$</p>", f"<p>$${long}$$</p>"):
        assert mk.foreign_kinds(value, "content"), value[:10]
    assert not mk.foreign_kinds(f"<p>{'** ' * 5000}</p>", "content") and mk.foreign_kinds("[b]" * 20_000, "markdown") == set()


def test_deep_nesting():
    deep = "<div><b>" * 300 + "core" + "</b></div>" * 300 + "<p>after</p>"
    assert mk.render_html(deep)[0] == "core\n\nafter"
    far = "<p>" + "<i>" * 5000 + "core" + "</i>" * 5000 + " rest</p><p>after</p>"
    assert mk.render_html(far)[0] == "core rest\n\nafter"
