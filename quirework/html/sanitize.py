"""Allowlist sanitizing of model HTML."""

from __future__ import annotations

import re

from quirework.html.prompt import ALLOWED_ATTRIBUTES, ALLOWED_TAGS
from quirework.html.tree import Node, parse, serialize

# Fixed values of the allowlist.
PAYLOAD_TAGS = frozenset(("script", "style", "iframe", "object", "embed", "noscript"))
SAFE_CSS = frozenset(
    (
        "color", "background-color", "font-size", "font-weight", "font-style", "font-family", "text-align", "text-decoration", "line-height",
        "padding", "margin", "border", "border-color", "border-style", "border-width", "white-space", "vertical-align",
    )
)
SAFE_SCHEMES = frozenset(("http", "https", "data", "mailto"))
URL_ATTRIBUTES = frozenset(("href", "src"))

_TAGS = frozenset(ALLOWED_TAGS)
_ATTRIBUTES = frozenset(ALLOWED_ATTRIBUTES)
_SCHEME = re.compile(r"^([a-z][a-z0-9+.-]*):")
_IGNORED_IN_URLS = re.compile(r"[\x00-\x20\x7f-\xa0​﻿]+")


def safe_url(url: str) -> bool:
    """Whether a link has no scheme or an allowed one; characters that browsers ignore don't hide a scheme."""
    scheme = _SCHEME.match(_IGNORED_IN_URLS.sub("", url).lower())
    return scheme is None or scheme[1] in SAFE_SCHEMES


def safe_style(style: str) -> str:
    """Declarations of allowed properties whose values fetch or run nothing."""
    kept = []
    for declaration in style.split(";"):
        name, colon, value = declaration.partition(":")
        plain = re.sub(r"/\*.*?\*/|\\", "", value).lower()
        if colon and name.strip().lower() in SAFE_CSS and not re.search(r"url\s*\(|expression\s*\(|javascript:|@import", plain):
            kept.append(f"{name.strip().lower()}: {value.strip()};")
    return " ".join(kept)


def _clean_attributes(node: Node) -> None:
    kept = {}
    for name, value in node.attrs.items():
        if name not in _ATTRIBUTES and not (name == "src" and node.tag in ("img", "a")):
            continue
        if name in URL_ATTRIBUTES and not safe_url(value):
            continue
        kept[name] = safe_style(value) if name == "style" else value
    node.attrs = kept


def clean_tree(root: Node) -> Node:
    """Remove payloads and comments with their content, unwrap other foreign tags, and drop foreign attributes."""
    stack = [root]
    while stack:
        node = stack.pop()
        kept: list[Node | str] = []
        queue = list(reversed(node.children))
        while queue:
            child = queue.pop()
            if isinstance(child, str):
                if kept and isinstance(kept[-1], str):
                    kept[-1] += child
                else:
                    kept.append(child)
            elif child.tag in PAYLOAD_TAGS or child.tag == "!":
                continue
            elif child.tag not in _TAGS:
                queue.extend(reversed(child.children))
            else:
                child.parent = node
                _clean_attributes(child)
                kept.append(child)
                stack.append(child)
        node.children = kept
    return root


def sanitize_html(html: str | None) -> str | None:
    """Sanitized HTML; null and empty values come back as they are. Sanitizing twice changes nothing."""
    if not html:
        return html
    return serialize(clean_tree(parse(html)))
