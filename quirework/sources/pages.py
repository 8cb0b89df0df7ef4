"""Pages of source documents.

Rendering needs a raster library, which this engine doesn't bring. A renderer is injected: it counts the pages of a
file's bytes, and renders chosen pages one after the other, so that pages that aren't wanted are never rendered and no
more than one is held at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Renderer(Protocol):
    """Counts and renders the pages of a document."""

    def count(self, content: bytes) -> int: ...

    def render(self, content: bytes, pages: list[int]) -> Iterator[tuple[int, bytes, int, int]]:
        """(page number, image, width, height) of each page."""
        ...


PAGE_SCHEMA = "doc_id string, page_num int, image binary, width int, height int, error boolean, error_message string"


def count_pages(files: DataFrame, factory: Callable[[], Renderer]) -> DataFrame:
    """Pages of each file: doc_id, total_pages. Needs doc_id and content; a PDF is known by its bytes, others have one
    page; files that can't be read have null."""

    @F.pandas_udf("int")
    def count(contents: pd.Series) -> pd.Series:
        renderer = factory()
        out = []
        for content in contents:
            try:
                out.append(renderer.count(content) if content[:4] == b"%PDF" else 1)
            except Exception:  # noqa: BLE001 - an unreadable file is a null
                out.append(None)
        return pd.Series(out, dtype="Int32")

    return files.select("doc_id", count("content").alias("total_pages"))


def render_pages(files: DataFrame, wanted: DataFrame, factory: Callable[[], Renderer]) -> DataFrame:
    """Rendered pages: doc_id, page_num, image, width, height, error, error_message.

    ``wanted`` holds doc_id and page_num; the numbers, not the contents, are grouped by document, and join the files.
    A file whose rendering fails gives an error row for every page that is left.
    """
    lists = wanted.groupBy("doc_id").agg(F.array_sort(F.collect_set("page_num")).alias("pages"))
    joined = files.select("doc_id", "content").join(lists, "doc_id").select("doc_id", "content", "pages")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        renderer = factory()
        for part in batches:
            for doc, content, pages in part.itertuples(index=False):
                left = [int(p) for p in pages]
                try:
                    for number, image, width, height in renderer.render(bytes(content), list(left)):
                        left.remove(number)
                        yield pd.DataFrame([(doc, number, image, width, height, False, None)], columns=[c.split()[0] for c in PAGE_SCHEMA.split(", ")])
                    message = "MissingPage: the renderer gave no such page"
                except Exception as exc:  # noqa: BLE001 - a failed file is failed pages
                    message = f"{type(exc).__name__}: {exc}"
                if left:
                    yield pd.DataFrame([(doc, n, None, None, None, True, message) for n in left], columns=[c.split()[0] for c in PAGE_SCHEMA.split(", ")]).astype({"width": "Int32", "height": "Int32"})

    return joined.mapInPandas(run, PAGE_SCHEMA)
