"""Problem 2: markup residue in text documents.

HTML is rendered by a layout-aware pass over a tree with implied end tags: invisible elements are dropped, every
visible text is emitted, blocks are set apart by blank lines, lists keep their bullets or numbers and nesting, table
cells are aligned in columns, code blocks are fenced and formulas keep their delimiters. Markdown is split into its own
constructs, code and formulas are kept as they stand, tables and foreign HTML go through the same renderer.

Elements that are hidden (by the ``hidden`` attribute, ``display:none`` or ``visibility:hidden``) are no visible text.

The renderer reports, while it renders, everything that isn't the field's own notation by kind: tags, attributes,
comments, character references that are still references after one decoding, wiki, LaTeX, BBCode and markdown signs.
Every value is rendered for that; signs that open and close are paired by one scan, however far they are apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.html.prompt import ALLOWED_ATTRIBUTES, ALLOWED_TAGS
from quirework.html.tree import BLOCK, Node, parse

# Further element names of HTML, for literal tags shown as text.
_HTML_NAMES = frozenset(
    "a abbr acronym address article aside audio b base big blink blockquote body br button canvas caption center cite code col del "
    "dd dfn dir div dl dt em embed fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html i "
    "iframe img input ins kbd label legend li link main map mark marquee math menu meta nav nobr noscript object ol optgroup option p "
    "param pre q s samp script section select small source span strike strong style sub summary sup svg table tbody td textarea tfoot "
    "th thead time title tr tt u ul var video wbr chem".split()
)
_HIDDEN = frozenset(("script", "style", "head", "template", "noscript", "iframe", "object", "embed", "!"))
_OWN_TAGS = frozenset(ALLOWED_TAGS) | {"div"}
_OWN_ATTRIBUTES = frozenset(ALLOWED_ATTRIBUTES)
_VERBATIM = frozenset(("pre", "code", "math", "chem", "kbd", "samp"))

_REFERENCE = re.compile(r"&(?:[a-zA-Z]{2,8}|#\d{2,6}|#[xX][0-9a-fA-F]{2,6});")
_RAW_REFERENCE = re.compile(r"&(?!(?:amp|lt|gt|quot|apos|#39|#x27);)(?:[a-zA-Z]{2,8}|#\d{2,6}|#[xX][0-9a-fA-F]{2,6});")
_LITERAL_TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*(?::[a-zA-Z]+)?)((?:\s[^<>]*)?)/?>|<!--|<!DOCTYPE", re.I)

#: Signs of other notations in plain text, each with the kind it is reported as.
_SIGNS: tuple[tuple[str, re.Pattern[str]], ...] = (
    ("wiki", re.compile(r"\[\[[^\[\]\n]+\]\]|\{\{[^{}\n]+\}\}|^[ \t]*(={2,6})[ \t]*[^=\s][^=\n]*?[ \t]*\1[ \t]*$|^\{\|[^\n]*$|^\|[}-][^\n|]*$", re.M)),
    ("latex", re.compile(r"(?<![\w\\:])\\(?:begin|end|[a-zA-Z]+\*?)[ \t]*(?:\[[^\]\n]*\])?\{|(?<![\w\\:/])\\(?:[a-zA-Z]{3,}|[a-z]{2})(?![\w\\/])")),
    ("directive", re.compile(r"^\.\. [a-z-]+::|^#\+[A-Za-z_]+:|^h[1-6]\. \S|:[a-z]+:`[^`\n]+`", re.M)),
)
_BBCODE = re.compile(r"\[(/?)(b|i|u|s|url|img|quote|code|list|size|color|center|font|spoiler|sub|sup)(?:=[^\]\n]*)?\]", re.I)
#: Markdown signs; foreign in HTML, and in markdown where they are escaped.
_MARKDOWN_SIGNS = re.compile(
    r"(?<!~)~~(?=\S)[^~\n]+~~(?!~)|!?\[[^\[\]\n]*\]\((?:https?:|#|/|[\w./-]+\.\w{2,5})[^()\s]*\)|(?<!`)`[^`\n]+`(?!`)|^```|^[ \t]*#{1,6} \S|^[ \t]*>[ \t]+\S|^[ \t]*[*+] \S"
    r"|^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*\|[ \t:|-]*$|\[\^[\w-]+\]|^[^\n]+\n[=]{3,}[ \t]*$", re.M
)
_FORMULA_SIGNS = re.compile(r"\\[a-zA-Z]|[\^_]")
_ESCAPED_SIGNS = re.compile(r"\\`[^`\n]+\\`|^\\#{1,6} \S|\\\[[^\[\]\n]*\\\]\\?\([^()\s]*\\?\)", re.M)


class _Pair:
    """Signs of which one opens and one closes: found by one scan, without a bound on what stands between them.

    A line end between them parts them if ``line`` is set. The closing sign must be the same as the opening one.
    """

    def __init__(self, opening: str, closing: str, line: bool = True) -> None:
        self.opening, self.closing = re.compile(opening), re.compile(closing)
        self.parts = re.compile("\n") if line else None

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        """(beginning, end) of what stands between the signs, the signs left out."""
        events = [(m.start(), 1, m) for m in self.opening.finditer(text)]
        if not events:
            return
        events += [(m.start(), 0, m) for m in self.closing.finditer(text)]
        if self.parts is not None:
            events += [(m.start(), 2, m) for m in self.parts.finditer(text)]
        events.sort(key=lambda e: (e[0], e[1]))
        opened: dict[str, int] = {}
        for at, kind, m in events:
            if kind == 2:
                opened.clear()
            elif kind == 0 and m[0] in opened and at > opened[m[0]]:
                yield opened.pop(m[0]), at
            elif kind == 1:
                opened.setdefault(m[0], m.end())

    def found(self, text: str) -> bool:
        return next(self.spans(text), None) is not None


_WIKI_EMPHASIS = _Pair(r"(?<![\w'])'{2,5}(?=[^\s'])", r"(?<=[^\s'])'{2,5}(?![\w'])")
_STARS = _Pair(r"(?<![\w*])\*{1,3}(?=[^\s*])", r"(?<=[^\s*])\*{1,3}(?![\w*])")
_LINES = _Pair(r"(?<![\w_])_{2,3}(?=[^\s_])", r"(?<=[^\s_])_{2,3}(?![\w_])")
_BOLD_LINES = _Pair(r"(?<![\w_\\])__(?=[^\s_])", r"(?<=[^\s_\\])__(?![\w_])")
_DISPLAY = _Pair(r"\$\$", r"\$\$", False)
_DOLLARS = _Pair(r"(?<![\w$])\$(?=[^\s$])", r"(?<=[^\s$])\$(?![\w$])")
_ESCAPED_PAIRS = (
    _Pair(r"(?<![\w\\])(?:\\\*){1,3}(?=[^\s\\*])", r"(?<=[^\s\\*])(?:\\\*){1,3}(?!\w)"), _Pair(r"(?<![\w\\])(?:\\_){2,3}(?=[^\s\\_])", r"(?<=[^\s\\_])(?:\\_){2,3}(?!\w)"),
    _Pair(r"\\~\\~", r"\\~\\~"),
)


def _between(text: str, opening: str, closing: str) -> bool:
    """Whether one sign stands before the other, with something between them."""
    at = text.find(opening)
    return at >= 0 and text.find(closing, at + len(opening) + 1) >= 0


def _bbcode(text: str) -> bool:
    """Whether a tag in brackets is opened and closed."""
    opened = set()
    for m in _BBCODE.finditer(text):
        if not m[1]:
            opened.add(m[2].lower())
        elif m[2].lower() in opened:
            return True
    return False


def signs(text: str, html: bool) -> set[str]:
    """Kinds of foreign notation in plain text (no code, no formulas)."""
    kinds = {kind for kind, pattern in _SIGNS if pattern.search(text)}
    if "''" in text and _WIKI_EMPHASIS.found(text):
        kinds.add("wiki")
    if "[/" in text and _bbcode(text):
        kinds.add("bbcode")
    if "&" in text and _REFERENCE.search(text):
        kinds.add("reference")
    if "<" in text:
        for m in _LITERAL_TAG.finditer(text):
            name = (m[1] or "").lower()
            if not name or name in _HTML_NAMES or ":" in name or re.search(r"\w=", m[2] or ""):
                kinds.add("literal tag")
                break
    if html:
        if ("*" in text and _STARS.found(text)) or ("__" in text and _LINES.found(text)) or _MARKDOWN_SIGNS.search(text):
            kinds.add("markdown")
        if "\\" in text and (_between(text, "\\[", "\\]") or _between(text, "\\(", "\\)")):
            kinds.add("latex")
        if "$" in text and (_DISPLAY.found(text) or any(_FORMULA_SIGNS.search(text, a, b) for a, b in _DOLLARS.spans(text))):
            kinds.add("latex")
    elif "\\" in text and (_ESCAPED_SIGNS.search(text) or any(p.found(text) for p in _ESCAPED_PAIRS)):
        kinds.add("markdown")
    return kinds


def hidden(node: Node) -> bool:
    """Whether an element isn't shown."""
    if node.tag in _HIDDEN or "hidden" in node.attrs:
        return True
    style = node.attrs.get("style", "")
    if not style:
        return False
    rules = dict((name.strip(), value.replace("!important", "").strip()) for name, _, value in (part.partition(":") for part in style.lower().split(";")))
    return rules.get("display") == "none" or rules.get("visibility") in ("hidden", "collapse")


class _Renderer:
    """Text of a tree with block spacing, lists, aligned tables, fenced code and formulas."""

    def __init__(self) -> None:
        self.kinds: set[str] = set()
        self.plain: list[str] = []
        self.kept: list[str] = []

    def keep(self, text: str) -> str:
        """A mark for text whose white space must stay as it is."""
        self.kept.append(text)
        return f"\x00{len(self.kept) - 1}\x00"

    def expand(self, text: str) -> str:
        """Text with what its marks stand for."""
        return _KEPT.sub(lambda m: self.kept[int(m[1])], text) if "\x00" in text else text

    def inspect(self, node: Node) -> None:
        if node.tag == "!":
            self.kinds.add("comment")
        elif node.tag not in _OWN_TAGS:
            self.kinds.add("tag")
        else:
            for name in node.attrs:
                if name not in _OWN_ATTRIBUTES and not (name == "src" and node.tag == "img"):
                    self.kinds.add("attribute")

    def inline(self, node: Node) -> str:
        """Text of inline content; white space is collapsed."""
        out: list[str] = []
        for child in node.children:
            if isinstance(child, str):
                self.plain.append(child)
                out.append(re.sub(r"\s+", " ", child))
                continue
            self.inspect(child)
            tag = child.tag
            if hidden(child):
                continue
            if tag == "br":
                self.plain.append("\n")
                out.append("\n")
            elif tag == "img":
                out.append(child.attrs.get("alt", ""))
            elif tag == "input":
                if child.attrs.get("type") in ("checkbox", "radio"):
                    out.append("[x]" if "checked" in child.attrs else "[ ]")
                else:
                    out.append(child.attrs.get("value", ""))
            elif tag == "math":
                tex = child.text().strip()
                self.plain.append(" ")
                out.append(f"\n$$\n{tex}\n$$\n" if child.attrs.get("display") == "block" else f"${tex}$")
            elif tag in ("code", "kbd", "samp"):
                self.plain.append(" ")
                out.append(f"`{child.text()}`")
            elif tag == "chem":
                self.plain.append(" ")
                out.append(child.text())
            elif tag in BLOCK:
                self.plain.append("\n\n")
                out.append("\n\n" + self.block(child) + "\n\n")
                self.plain.append("\n\n")
            else:
                out.append(self.inline(child))
        return "".join(out)

    def block(self, node: Node) -> str:
        tag = node.tag
        if tag == "pre":
            for child in node.elements():
                self.inspect(child)
            self.plain.append("\n")
            return self.keep("```\n" + node.text().strip("\n") + "\n```")
        if tag == "table":
            return self.keep(self.table(node))
        if tag in ("ul", "ol"):
            return self.keep(self.list(node, tag == "ol"))
        if tag == "hr":
            return "---"
        text = _tidy(self.inline(node))
        if re.fullmatch(r"h[1-6]", tag) and text:
            return "#" * int(tag[1]) + " " + " ".join(self.expand(text).split())
        return text

    def list(self, node: Node, ordered: bool) -> str:
        lines: list[str] = []
        number = 1
        for child in node.children:
            if isinstance(child, str):
                if child.strip():
                    self.plain.append(child)
                    lines.append(" ".join(child.split()))
                continue
            self.inspect(child)
            if hidden(child):
                continue
            self.plain.append("\n")
            text = self.expand(_tidy(self.inline(child))).replace("\n\n", "\n") if child.tag not in ("ul", "ol") else self.list(child, child.tag == "ol")
            mark = f"{number}. " if ordered else "- "
            number += 1
            body = text.split("\n") or [""]
            lines.append(mark + body[0])
            lines.extend("  " + x for x in body[1:] if x.strip())
        return "\n".join(lines)

    def table(self, node: Node) -> str:
        caption: str = ""
        rows: list[dict[int, str]] = []
        taken: dict[int, int] = {}  # column -> rows that a cell from above still takes up
        for child in node.elements():
            if child.tag == "caption":
                self.inspect(child)
                self.plain.append("\n")
                caption = " ".join(self.expand(self.inline(child)).split())
            elif child.tag == "tr":
                self.inspect(child)
                if hidden(child):
                    continue
                cells: dict[int, str] = {}
                column, below = 0, {c: n - 1 for c, n in taken.items() if n > 1}
                for cell in child.children:
                    if isinstance(cell, str):
                        self.plain.append(cell)
                        continue
                    self.inspect(cell)
                    if hidden(cell):
                        continue
                    self.plain.append("\n")
                    while taken.get(column):
                        column += 1
                    text = " ".join(self.expand(self.inline(cell)).split())
                    wide, deep = _span(cell, "colspan"), _span(cell, "rowspan")
                    cells[column] = text
                    if deep > 1 and wide <= _WIDE:
                        below.update({column + k: deep - 1 for k in range(wide)})
                    column += wide
                taken = below
                rows.append(cells)
            elif child.tag in ("thead", "tbody", "tfoot") or child.tag not in ("td", "th", "tr", "caption") and child.parent is node:
                self.inspect(child)
        # Columns in which no cell begins, as under wide cells only, take no room.
        used = sorted({c for r in rows for c in r})
        width = {c: max(len(r[c]) for r in rows if c in r) for c in used}
        lines = ["  ".join(r.get(c, "").ljust(width[c]) for c in used).rstrip() for r in rows]
        return "\n".join([caption] * bool(caption) + lines)


#: Cells that take up more columns than this don't reach into the rows below.
_WIDE = 10_000


def _span(cell: Node, name: str) -> int:
    value = cell.attrs.get(name, "1").strip()
    return max(1, int(value)) if value.isascii() and value.isdigit() and len(value) < 10 else 1


_KEPT = re.compile("\x00(\\d+)\x00")


def _tidy(text: str) -> str:
    text = re.sub(r"[ \t]*\n[ \t]*", "\n", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def render_html(html: str | None) -> tuple[str, set[str]]:
    """Clean text of an HTML value and the kinds of foreign markup in it. Null and empty values give ''."""
    if not html:
        return "", set()
    renderer = _Renderer()
    text = renderer.expand(_tidy(renderer.inline(parse(html.replace("\x00", " ")))))
    kinds = renderer.kinds
    if "&" in html and _RAW_REFERENCE.search(html):
        kinds.add("reference")
    kinds |= signs("".join(renderer.plain), True)
    return text, kinds


_FENCE = re.compile(r"^(```+|~~~+)[^\n]*\n.*?(?:^\1[ \t]*$|\Z)", re.M | re.S)
_OWN_MARKDOWN = re.compile(
    r"(?P<table><table\b.*?</table>)|(?P<math>\$\$.+?\$\$|(?<![\\\w$])\$(?=[^\s$])[^$\n]*?(?<=[^\s\\])\$(?![\w$])|(?<!\\)(?<=\s)\$[^$\n]+\$(?=\s))|(?P<code>(?<![\\`])`[^`\n]+`)"
    r"|(?P<image>!\[(?:\\.|[^\[\]\\])*\]\([^()\s]*\))|(?P<link>\[(?:\\.|[^\[\]\\])*\]\([^()\s]*\))|(?P<script></?su[bp]>)", re.S
)
_UNESCAPE = re.compile(r"\\([\\`*_{}\[\]()#+\-.!$<>~|&])")


def _rendered_line(line: str) -> str:
    """A line of markdown with foreign HTML; the marks of what is kept pass through."""
    renderer = _Renderer()
    return renderer.expand(_tidy(renderer.inline(parse(line.replace("\x00", "\x01"))))).replace("\x01", "\x00")


def render_markdown(markdown: str | None) -> tuple[str, set[str]]:
    """Clean text of a markdown value and the kinds of foreign markup in it. Null and empty values give ''."""
    if not markdown:
        return "", set()
    kinds: set[str] = set()
    kept: list[str] = []

    def keep(text: str) -> str:
        kept.append(text)
        return f"\x00{len(kept) - 1}\x00"

    def own(m: re.Match[str]) -> str:
        if m["table"]:
            text, found = render_html(m[0])
            kinds.update(found)
            return keep(text)
        if m["image"]:
            return m[0][2 : m[0].rindex("](")]
        if m["link"]:
            return m[0][1 : m[0].rindex("](")]
        return keep("") if m["script"] else keep(m[0])

    text = _FENCE.sub(lambda m: keep(m[0].rstrip()), markdown.replace("\x00", " "))
    text = _OWN_MARKDOWN.sub(own, text)
    bare = re.sub(r"\x00\d+\x00", " ", text)
    found = signs(re.sub(r"(?<!\\)\*{1,3}(?=\S)([^*\n]+?)(?<!\\)\*{1,3}", r"\1", bare), False)
    kinds |= found
    if "__" in bare and _BOLD_LINES.found(bare):
        kinds.add("markdown")
    if "literal tag" in found or "reference" in found:
        # Foreign HTML in the text: rendered by the same tree, paragraph by paragraph.
        text = "\n".join(_rendered_line(x) if "<" in x or "&" in x else x for x in text.split("\n"))
    text = re.sub(r"(?<![\\*])\*{1,3}(?=\S)([^*\n]+?)(?<!\\)\*{1,3}|~~([^~\n]+)~~", r"\1\2", text)
    text = re.sub(r"'{2,5}([^\n']+)'{2,5}|\[\[(?:[^\[\]|\n]*\|)*([^\[\]|\n]+)\]\]|\{\{(?:[^{}|\n]*\|)*([^{}|\n]+)\}\}", r"\1\2\3", text) if "wiki" in found else text
    text = re.sub(r"\\(?:begin|end)\{[^{}]*\}(?:\{[^{}]*\})?|\\[a-zA-Z]+\*?(?:\[[^\]\n]*\])?\{([^{}\n]*)\}|\\(?:item|\\)", r"\1", text) if "latex" in found else text
    text = re.sub(r"\[/?(?:b|i|u|s|url|img|quote|code|list|size|color|center|font)(?:=[^\]\n]*)?\]", "", text, flags=re.I) if "bbcode" in found else text
    text = _UNESCAPE.sub(r"\1", text)
    text = _KEPT.sub(lambda m: kept[int(m[1])], text)
    return re.sub(r"\n{3,}", "\n\n", text).strip(), kinds


def foreign_kinds(value: str | None, field: str) -> set[str]:
    """Kinds of foreign markup that rendering a value of a field reports."""
    if not value:
        return set()
    return (render_markdown if field == "markdown" else render_html)(value)[1]


SCHEMA_FOUND = "doc_id string, page_num int, field string, kinds array<string>"


def foreign_markup(artifacts: DataFrame) -> DataFrame:
    """Field values with foreign markup: doc_id, page_num, field, kinds; 'content' once per page.

    Null and empty values have no row; repeated rows give repeated rows; pages with null keys keep their null keys.
    """
    pages = artifacts.select("doc_id", "page_num", "markdown", "html_filtered", F.transform("chunks", lambda c: c["content"]).alias("contents"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = []
            for doc, page, markdown, html, contents in zip(part["doc_id"], part["page_num"], part["markdown"], part["html_filtered"], part["contents"]):
                seen = {"markdown": foreign_kinds(markdown, "markdown"), "html_filtered": foreign_kinds(html, "html_filtered"), "content": set()}
                for content in contents if contents is not None else ():
                    seen["content"] |= foreign_kinds(content, "content")
                rows += [(doc, page, field, sorted(kinds)) for field, kinds in seen.items() if kinds]
            yield pd.DataFrame(rows, columns=["doc_id", "page_num", "field", "kinds"])

    return pages.mapInPandas(run, SCHEMA_FOUND)


def clean_text(df: DataFrame, column: str, notation: str) -> DataFrame:
    """``df`` with the columns clean_text and foreign_kinds of ``column``; ``notation`` is 'html' or 'markdown'.

    A null value has a null clean text. Existing columns of these names are replaced; all others are kept.
    """
    if notation not in ("html", "markdown"):
        raise ValueError("notation is 'html' or 'markdown'")
    render = render_html if notation == "html" else render_markdown

    @F.pandas_udf("struct<text: string, kinds: array<string>>")
    def rendered(values: pd.Series) -> pd.DataFrame:
        pairs = [(None, []) if v is None else render(v) for v in values]
        return pd.DataFrame({"text": [p[0] for p in pairs], "kinds": [sorted(p[1]) for p in pairs]})

    own = "_rendered"
    while own in df.columns:
        own += "_"
    made = df.withColumn(own, rendered(F.col(column)))
    kept = [c for c in df.columns if c not in ("clean_text", "foreign_kinds")]
    return made.select(*kept, F.col(f"{own}.text").alias("clean_text"), F.col(f"{own}.kinds").alias("foreign_kinds"))
