"""Running text of a markdown value: paragraphs without headings, lists, tables, code, formulas and addresses."""

from __future__ import annotations

import re

_FENCED = re.compile(r"^(```+|~~~+)[^\n]*\n.*?(?:^\1[ \t]*$|\Z)", re.M | re.S)
_TABLE = re.compile(r"<table\b.*?</table>", re.S)
_FORMULA = re.compile(r"\$\$.+?\$\$", re.S)
_OTHER_LINE = re.compile(r"#{1,6} |[ \t]*[-*+] |[ \t]*\d{1,3}[.)] |!\[[^\]\n]*\]\([^()\n]*\)[ \t]*$|\d*-{20,}[ \t]*$|\{\||\|[-}]|[!|] |[ \t]*\\(?:begin|end|item)\b")
_SIGNS = re.compile(r"[<\[\]`*~$\\&]")
_DROP_SIMPLE = re.compile(r"(?<![\\\w])\$(?=\S)[^$\n]{1,120}\$|<!--.*?-->|</?[a-zA-Z][^<>]*>|!?\[(?=[^\[\]\n]*\]\()|\]\([^()\s]*\)|(?<!\\)[\[\]`*~]|\\(?=[^\w\s])|&[a-z#0-9]{2,8};", re.S)
_HYPHEN = re.compile(r"(\w)[-­¬‐]\s*\n\s*(?=\w)")
_PARAGRAPH = re.compile(r"\n\s*\n")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"'»”’)]*\s+(?=\S)")
_CLOSED = re.compile(r"[.!?…][\"'»”’)]*$")


def _is_other(line: str) -> bool:
    """Whether a line is no running text; leaders of four dots or more are enough."""
    return "...." in line or _OTHER_LINE.match(line) is not None


def paragraphs(markdown: str) -> list[str]:
    """Paragraphs of running text, each on one line."""
    text = markdown
    if "```" in text or "~~~" in text:
        text = _FENCED.sub("\n\n", text)
    if "<table" in text:
        text = _TABLE.sub("\n\n", text)
    if "$$" in text:
        text = _FORMULA.sub("\n\n", text)
    out = []
    for block in _PARAGRAPH.split(text):
        if "\n" not in block:
            if _is_other(block):
                continue
            _add(out, block)
            continue
        kept: list[str] = []
        for line in block.split("\n"):
            if _is_other(line):
                _add(out, "\n".join(kept))
                kept = []
            else:
                kept.append(line)
        _add(out, "\n".join(kept))
    return out


def _add(out: list[str], block: str) -> None:
    """Add a block to the paragraphs if it is running text: four words or more, at least half of them in lower case."""
    if _SIGNS.search(block):
        block = _DROP_SIMPLE.sub("", block)
    if "\n" in block:
        block = _HYPHEN.sub(r"\1", block)
    words = block.split()
    if len(words) >= 4 and sum(map(str.islower, [w[0] for w in words])) * 2 >= len(words):
        out.append(" ".join(words))


def sentences(paragraph: str) -> list[str]:
    """Sentences of a paragraph; the last may be unfinished."""
    return _SENTENCE.split(paragraph)


def is_full(sentence: str) -> bool:
    """Whether a sentence is finished and has at least four words."""
    return _CLOSED.search(sentence) is not None and sentence.count(" ") >= 3
