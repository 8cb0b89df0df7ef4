"""Markdown of a page's flow HTML."""

from __future__ import annotations

import re

from quirework.html.tree import Node, serialize

_SPACE = re.compile(r"[ \t]+")
_STARS = re.compile(r"([*_$])")
_BRACKETS = re.compile(r"([\[\]()])")
_VERBATIM = frozenset(("pre", "code", "kbd", "samp", "math"))
_BLOCK_BREAK = frozenset(("p", "div", "table", "ul", "ol", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "caption"))
_MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "del": "~~", "s": "~~"}


def escape(text: str) -> str:
    """Text with the signs that markdown or formulas would take for their own."""
    return _STARS.sub(r"\\\1", text)


def _wrap(text: str, mark: str) -> str:
    """``text`` between marks; white space at its ends stays outside."""
    inner = text.strip()
    if not inner:
        return text
    lead = text[: len(text) - len(text.lstrip())]
    trail = text[len(text.rstrip()) :]
    return f"{lead[:1]}{mark}{inner}{mark}{trail[:1]}"


class Converter:
    """Turns a tree into markdown: ATX headings, dash bullets, tables as HTML, formulas between dollars."""

    def convert(self, root: Node) -> str:
        text = self.children(root, frozenset())
        return re.sub(r"\n{3,}", "\n\n", text).strip()

    def children(self, node: Node, above: frozenset[str]) -> str:
        inside = above | {node.tag}
        parts: list[str] = []
        last = len(node.children) - 1
        for k, child in enumerate(node.children):
            if isinstance(child, Node):
                piece = self.element(child, inside)
                if child.tag in _BLOCK_BREAK and parts and not (child.tag in ("ul", "ol") and "li" in inside):
                    parts[-1] = parts[-1].rstrip(" ")
                if piece[:1] == " " and parts and parts[-1][-1:] == " ":
                    piece = piece[1:]
                parts.append(piece)
                continue
            text = child
            if "pre" not in inside:
                text = _SPACE.sub(" ", text)
                before = node.children[k - 1] if k else None
                after = node.children[k + 1] if k < last else None
                if (isinstance(before, Node) and before.tag in _BLOCK_BREAK | {"br"}) or (k == 0 and node.tag in _BLOCK_BREAK | {"", "li"}):
                    text = text.lstrip(" ")
                if (isinstance(after, Node) and after.tag in _BLOCK_BREAK) or (k == last and node.tag in _BLOCK_BREAK | {"", "li"}):
                    text = text.rstrip(" ")
            if text[:1] == " " and parts and parts[-1][-1:] == " ":
                text = text[1:]
            if not inside & _VERBATIM:
                text = escape(text)
            parts.append(text)
        return "".join(parts)

    def element(self, node: Node, above: frozenset[str]) -> str:
        tag = node.tag
        if tag == "math":
            tex = node.text().strip()
            return f"\n$${tex}$$\n" if node.attrs.get("display") == "block" else f" ${tex}$ "
        if tag == "table":
            return f"\n\n{serialize_table(node)}\n\n"
        if tag == "br":
            return " " if above & {"h1", "h2", "h3", "h4", "h5", "h6"} else "\n"
        if tag == "hr":
            return "\n\n---\n\n"
        if tag == "img":
            alt, src = node.attrs.get("alt", ""), node.attrs.get("src", "")
            return alt if above & {"h1", "h2", "h3", "h4", "h5", "h6"} else f"![{alt}]({src})"
        if tag == "input":
            return ""
        if tag == "pre":
            return f"\n\n```\n{node.text().strip(chr(10))}\n```\n\n"
        if tag in ("ul", "ol"):
            return self.list(node, above)
        text = self.children(node, above)
        if re.fullmatch(r"h[1-6]", tag):
            title = " ".join(text.split())
            return f"\n\n{'#' * int(tag[1])} {title}\n\n" if title else ""
        if tag in ("p", "div", "caption", "li"):
            text = text.strip(" \n") if tag != "li" else text
            return f"\n\n{text}\n\n" if text else ""
        if tag in ("code", "kbd", "samp"):
            return _wrap(text, "`" if "`" not in text else "``") if "pre" not in above else text
        if tag in ("sub", "sup"):
            return f"<{tag}>{text}</{tag}>" if text.strip() else text
        if tag in _MARKS:
            return _wrap(text, _MARKS[tag]) if not above & {"code", "pre"} else text
        if tag == "a":
            label = _BRACKETS.sub(r"\\\1", text).strip()
            href = node.attrs.get("href")
            return f"[{label}]({href})" if href and label else text
        return text

    def list(self, node: Node, above: frozenset[str]) -> str:
        lines: list[str] = []
        number = int(node.attrs["start"]) if node.attrs.get("start", "").isdigit() else 1
        for child in node.children:
            if not isinstance(child, Node):
                continue
            if child.tag in ("ul", "ol"):
                body = self.list(child, above | {node.tag, "li"}).strip("\n").split("\n")
                lines.extend("  " + x for x in body)
                continue
            text = re.sub(r"\n{2,}", "\n\n", self.children(child, above | {node.tag})).strip()
            mark = "- " if node.tag == "ul" else f"{number}. "
            number += 1
            body = re.sub(r"\n\n(?=\s*(?:-|\d+\.) )", "\n", text).split("\n")
            lines.append(mark + body[0])
            lines.extend((" " * len(mark) + x) if x else x for x in body[1:])
        text = "\n".join(lines)
        return f"\n{text}" if "li" in above else f"\n\n{text}\n\n"


def serialize_table(node: Node) -> str:
    return serialize(node)


def to_markdown(flow: Node) -> str:
    """Markdown of a flow tree, stripped."""
    return Converter().convert(flow)
