"""A small HTML tree: one tokenizing pattern, implied end tags, and serialization.

The builder never fails: unknown tags are elements, stray end tags are dropped, and what is left open at the end is
closed there. End tags are implied by the element that follows where HTML says so (paragraphs, list items, cells).
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import unescape

# Fixed values of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset(("script", "style", "textarea", "title", "noscript", "iframe"))
BLOCK = frozenset(
    "address article aside blockquote center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr li main nav ol p pre section table tbody td tfoot th thead tr ul caption".split()
)
#: Start tag -> the open elements it ends, and the elements beyond which it doesn't look for them.
_CLOSES_P = BLOCK - {"li", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "dd", "dt"}
IMPLIED: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    **{t: (frozenset(("p",)), frozenset(("td", "th", "li", "div", "table", "caption", "button"))) for t in _CLOSES_P},
    "li": (frozenset(("li", "p")), frozenset(("ul", "ol", "div", "table"))),
    "dd": (frozenset(("dd", "dt", "p")), frozenset(("dl", "div"))),
    "dt": (frozenset(("dd", "dt", "p")), frozenset(("dl", "div"))),
    "td": (frozenset(("td", "th", "p")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th", "p")), frozenset(("tr", "table"))),
    "tr": (frozenset(("tr", "td", "th", "p")), frozenset(("table", "tbody", "thead", "tfoot"))),
    "tbody": (frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "p")), frozenset(("table",))),
    "thead": (frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "p")), frozenset(("table",))),
    "tfoot": (frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "p")), frozenset(("table",))),
    "option": (frozenset(("option",)), frozenset(("select",))),
}
#: Elements nested more deeply than this stand beside each other; their end tags end nothing else, and no text is lost.
MAX_DEPTH = 1000
#: Walks that go down a tree by calls need a few of them for every level.
sys.setrecursionlimit(max(sys.getrecursionlimit(), 12 * MAX_DEPTH))
#: Elements an end tag can't reach out of.
_SCOPE = frozenset(("table", "td", "th", "caption"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![A-Za-z\[][^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/<>=\"']*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
_ATTR = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]+))?""")


class Node:
    """An element. Children are nodes or strings (text, already unescaped)."""

    __slots__ = ("tag", "attrs", "children", "parent", "depth")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, parent: Node | None = None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs or {}, parent
        self.children: list[Node | str] = []
        self.depth: int = parent.depth + 1 if parent is not None else 0

    def elements(self) -> Iterator[Node]:
        """All elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self) -> str:
        """All text below."""
        out: list[str] = []
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                out.append(item)
            else:
                stack.extend(reversed(item.children))
        return "".join(out)

    def remove(self) -> None:
        if self.parent is not None:
            self.parent.children = [c for c in self.parent.children if c is not self]


def attributes(source: str) -> dict[str, str]:
    """Attributes of a start tag; of repeated names the first counts."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(source):
        value = m[2] or ""
        if value[:1] in "\"'" and value[:1] == value[-1:] and len(value) > 1:
            value = value[1:-1]
        out.setdefault(m[1].lower(), unescape(value) if "&" in value else value)
    return out


def parse(html: str, implied: bool = True) -> Node:
    """Tree of ``html`` under a nameless root. Comments and declarations are kept as ``!`` elements."""
    root = Node("")
    top = root
    beyond: list[str] = []  # open elements below MAX_DEPTH
    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        if m is None:
            break
        if m.start() > at:
            text = html[at : m.start()]
            top.children.append(unescape(text) if "&" in text else text)
        at = m.end()
        name = m[2]
        if name is None:
            top.children.append(Node("!", {"source": m[0]}, top))
            continue
        name = name.lower()
        if m[1]:
            if name in beyond:
                while beyond.pop() != name:
                    pass
                continue
            beyond.clear()
            node: Node | None = top
            while node is not None and node.tag != name:
                node = None if node.tag in _SCOPE and name not in ("table", "tr", "tbody", "thead", "tfoot") else node.parent
            if node is not None and node.parent is not None:
                top = node.parent
            continue
        if implied and name in IMPLIED:
            ends, barrier = IMPLIED[name]
            node, last = top, None
            while node is not None and node.tag and node.tag not in barrier:
                if node.tag in ends:
                    last = node
                node = node.parent
            if last is not None and last.parent is not None:
                top = last.parent
        source = m[3]
        child = Node(name, attributes(source) if source.strip(" \t\n/") else None, top)
        top.children.append(child)
        if name in VOID or (source.endswith("/") and name not in BLOCK and name not in RAW_TEXT):
            continue
        if name in RAW_TEXT:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            stop = end.start() if end else size
            if stop > at:
                child.children.append(html[at:stop])
            at = end.end() if end else size
            continue
        if child.depth < MAX_DEPTH:
            top = child
        else:
            beyond.append(name)
    if at < size:
        text = html[at:]
        top.children.append(unescape(text) if "&" in text else text)
    return root


def escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def serialize(node: Node, inner: bool = False) -> str:
    """HTML of ``node``; with ``inner``, of its children only. Every special character is escaped once."""
    out: list[str] = []
    stack: list[Node | str | tuple[str]] = list(reversed(node.children)) if inner or not node.tag else [node]
    while stack:
        item = stack.pop()
        if isinstance(item, tuple):
            out.append(item[0])
        elif isinstance(item, str):
            out.append(escape(item))
        elif item.tag == "!":
            out.append(item.attrs["source"])
        else:
            attrs = "".join(f' {k}="{escape(v).replace(chr(34), "&quot;")}"' for k, v in item.attrs.items())
            if item.tag in VOID:
                out.append(f"<{item.tag}{attrs}/>")
                continue
            out.append(f"<{item.tag}{attrs}>")
            stack.append((f"</{item.tag}>",))
            if item.tag in RAW_TEXT:
                out.append(item.text())
            else:
                stack.extend(reversed(item.children))
    return "".join(out)
