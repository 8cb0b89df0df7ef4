"""Model output to page artifacts: one Python pass per page, in which the HTML is sanitized and parsed once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.html.layout import BBOX_SCALE, Page
from quirework.html.markdown import to_markdown
from quirework.html.tree import serialize

CHUNK = "struct<bbox: array<int>, label: string, content: string, page: int, chunk_id: string, image_ref: string, image_name: string>"
ARTIFACT_SCHEMA = (
    "doc_id string, page_num int, raw_html string, markdown string, html_filtered string, page_box array<int>, token_count int, error boolean, "
    f"error_message string, chunks array<{CHUNK}>, image_files array<string>"
)
_INPUT = ("doc_id", "page_num", "raw", "width", "height", "stem", "token_count", "error", "error_message")


def parse_page(raw: str, width: int, height: int, stem: str | None, page_num: int | None, headers_footers: bool = False, images: bool = True, scale: int = BBOX_SCALE) -> dict:
    """Everything that is derived from a page's model output."""
    page = Page(raw)
    flow = page.flow(headers_footers, images)
    return {
        "markdown": to_markdown(flow), "html_filtered": serialize(flow), "page_box": [0, 0, width, height],
        "chunks": page.chunks(width, height, stem, page_num, scale), "image_files": [name for name, _ in page.images(width, height)],
    }


def parse_pages(pages: DataFrame, headers_footers: bool = False, images: bool = True, scale: int = BBOX_SCALE) -> DataFrame:
    """Artifacts of pages: doc_id, page_num, raw_html, markdown, html_filtered, page_box, token_count, error,
    error_message, chunks, image_files.

    Needs doc_id, page_num, raw, width, height; stem, token_count, error and error_message are taken if they are there.
    A failed page, or one whose output is null or can't be parsed, becomes an error artifact without texts; the run
    goes on. Pages without a size count as ``scale`` square.
    """
    columns = {c: F.col(c) if c in pages.columns else F.lit(None) for c in _INPUT}
    kinds = {"page_num": "int", "width": "int", "height": "int", "token_count": "int", "error": "boolean"}
    selected = pages.select(*[c.cast(kinds.get(name, "string")).alias(name) for name, c in columns.items()])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = []
            for doc, num, raw, width, height, stem, tokens, error, message in part.itertuples(index=False):
                number = None if pd.isna(num) else int(num)
                w, h = (scale if pd.isna(x) else int(x) for x in (width, height))
                made: dict = {"markdown": "", "html_filtered": "", "page_box": [0, 0, w, h], "chunks": [], "image_files": []}
                failed = bool(error) if error is not None and not pd.isna(error) else False
                if not failed and raw is None:
                    failed, message = True, message or "ValueError: empty reply"
                if not failed:
                    try:
                        made = parse_page(raw, w, h, stem, number, headers_footers, images, scale)
                    except Exception as exc:  # noqa: BLE001 - a page's failure is a row
                        failed, message = True, f"{type(exc).__name__}: {exc}"
                rows.append(
                    {
                        "doc_id": doc, "page_num": number, "raw_html": "" if failed else raw, **made,
                        "token_count": 0 if pd.isna(tokens) else int(tokens), "error": failed, "error_message": message if failed else None,
                    }
                )
            yield pd.DataFrame(rows, columns=list(_ARTIFACT_COLUMNS)).astype({"page_num": "Int32"})

    return selected.mapInPandas(run, ARTIFACT_SCHEMA)


_ARTIFACT_COLUMNS = (
    "doc_id", "page_num", "raw_html", "markdown", "html_filtered", "page_box", "token_count", "error", "error_message", "chunks", "image_files"
)


def sanitized(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``column`` sanitized; null and empty values stay as they are."""
    from quirework.html.sanitize import sanitize_html

    @F.pandas_udf("string")
    def clean(values: pd.Series) -> pd.Series:
        return values.map(lambda v: sanitize_html(v) if v is not None else None)

    return df.withColumn(column, clean(F.col(column)))


def inlined(html: str, urls: dict[str, str]) -> str:
    """HTML whose images are replaced by data URLs; images with a description are wrapped together with it."""
    from quirework.html.tree import Node, parse

    root = parse(html)
    for node in list(root.elements()):
        if node.tag != "img" or node.attrs.get("src") not in urls:
            continue
        node.attrs["src"] = urls[node.attrs["src"]]
        alt = node.attrs.get("alt", "")
        if not alt or node.parent is None:
            continue
        siblings = node.parent.children
        wrapper = Node("div", {"class": "image-wrapper"}, node.parent)
        text = Node("div", {"class": "image-alt-text"}, wrapper)
        text.children = [alt]
        frame = Node("div", {"class": "image-container-wrapper"}, wrapper)
        frame.children = [node]
        wrapper.children = [text, frame]
        siblings[next(k for k, c in enumerate(siblings) if c is node)] = wrapper
        node.parent = frame
    return serialize(root)


def with_inline_images(df: DataFrame, html: str, urls: str) -> DataFrame:
    """``df`` with data URLs in the column ``html``; ``urls`` is a column that maps file names to them."""

    @F.pandas_udf("string")
    def replace(texts: pd.Series, maps: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or not m else inlined(t, dict(m)) for t, m in zip(texts, maps)])

    return df.withColumn(html, replace(F.col(html), F.col(urls)))
