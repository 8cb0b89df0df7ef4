"""What the page model is told to emit: tags, attributes and block labels."""

from __future__ import annotations

# Fixed values of the model's prompt.
ALLOWED_TAGS = (
    "math", "br", "i", "b", "u", "del", "sup", "sub", "table", "tr", "td", "p", "th", "div", "pre", "h1", "h2", "h3", "h4", "h5", "ul", "ol", "li",
    "input", "a", "span", "img", "hr", "tbody", "small", "caption", "strong", "thead", "big", "code", "chem",
)
ALLOWED_ATTRIBUTES = ("class", "colspan", "rowspan", "display", "checked", "type", "border", "value", "style", "href", "alt", "align", "data-bbox", "data-label")
LABELS = (
    "Caption", "Footnote", "Equation-Block", "List-Group", "Page-Header", "Page-Footer", "Image", "Section-Header", "Table", "Text", "Complex-Block",
    "Code-Block", "Form", "Table-Of-Contents", "Figure", "Chemical-Block", "Diagram", "Bibliography", "Blank-Page",
)
