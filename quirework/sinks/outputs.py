"""Writing artifacts, states and assembled documents."""

from __future__ import annotations

import shutil
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.operators import assemble

PURGE_WAITS = (0, 0.1, 0.25, 0.5, 1.0, 2.0)


def write_text(path: str | Path, content: str) -> None:
    """Write a small file as a whole or not at all, for what the driver itself writes."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    temporary = path.with_name(path.name + ".tmp")
    temporary.write_text(content, encoding="utf-8")
    temporary.replace(path)


def append_artifacts(artifacts: DataFrame, folder: str) -> None:
    """Append page artifacts, failed ones too; Spark's commit makes a write visible as a whole."""
    artifacts.write.mode("append").parquet(folder)


def append_states(states: DataFrame, folder: str) -> None:
    """Append run states: doc_id, run_no, source, expected_pages."""
    sorted_states = states.withColumn("expected_pages", F.array_sort("expected_pages"))
    sorted_states.write.mode("append").parquet(folder)


def state_rows(documents: DataFrame, run_no: int, pages: Column) -> DataFrame:
    """States of a run over documents with doc_id, path, length, modification_time."""
    source = F.struct("path", F.col("length").alias("size"), (F.unix_micros("modification_time") / 1e6).alias("mtime"))
    return documents.select("doc_id", F.lit(run_no).alias("run_no"), source.alias("source"), F.array_sort(pages).alias("expected_pages"))


def write_documents(artifacts: DataFrame, names: DataFrame, folder: str, paginated: bool = False, html: bool = True) -> None:
    """Markdown, metadata, chunks and, if asked for, HTML of every document, each a dataset under the folder.

    Documents of any size are written in parts; metadata are one row per document and one per page. Chunks are JSON
    lines in document order. ``assemble.metadata_json`` gives metadata as one value for documents that fit in one.
    """
    parts = assemble.assemble_parts(artifacts, paginated)
    parts.select("doc_id", "part", "n_pages", "markdown").write.mode("overwrite").parquet(f"{folder}/markdown")
    if html:
        parts.select("doc_id", "part", "n_pages", "html").write.mode("overwrite").parquet(f"{folder}/html")
    totals = assemble.document_metadata(artifacts).join(names.select("doc_id", "file_name").distinct(), "doc_id", "left")
    totals.write.mode("overwrite").parquet(f"{folder}/metadata")
    assemble.page_metadata(artifacts).write.mode("overwrite").parquet(f"{folder}/pages")
    chunks = assemble.document_chunks(artifacts)
    chunks.repartitionByRange("doc_id", "page_num").sortWithinPartitions("doc_id", "page_num", "position").write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/chunks")


def export_files(documents: DataFrame, folder: str, column: str, suffix: str, name: str | None = None) -> None:
    """One file per document in ``folder``, for a file system all executors share: needs stem and ``column``.

    The file is called ``name``, or after the stem with ``suffix``.
    """

    def save(rows) -> None:  # noqa: ANN001
        for row in rows:
            write_text(Path(folder) / row["stem"] / (name or f"{row['stem']}{suffix}"), row["content"] or "")

    documents.select("stem", F.col(column).alias("content")).foreachPartition(save)


def export_documents(artifacts: DataFrame, documents: DataFrame, folder: str, paginated: bool = False, html: bool = True) -> None:
    """``<stem>.md``, ``.html``, ``_metadata.json`` and ``chunks.jsonl`` of every document, each in a folder of its name.

    For documents that fit a value each, and a file system that all executors share; :func:`write_documents` takes
    documents of any size. ``documents``: doc_id, stem, file_name. Documents of the same stem share a folder, the later
    one goes before.
    """
    names = documents.select("doc_id", "stem", "file_name").distinct()
    whole = assemble.assemble(artifacts, paginated).join(names.select("doc_id", "stem"), "doc_id")
    export_files(whole, folder, "markdown", ".md")
    if html:
        export_files(whole, folder, "html", ".html")
    export_files(assemble.metadata_json(artifacts, names).join(names.select("doc_id", "stem"), "doc_id"), folder, "metadata", "_metadata.json")
    chunks = assemble.document_chunks(artifacts)
    fields = F.struct(*[c for c in chunks.columns if c not in ("doc_id", "page_num", "position")])
    rows = chunks.select("doc_id", F.struct("page_num", "position", F.to_json(fields, {"ignoreNullFields": "false"}).alias("line")).alias("c"))
    texts = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list("c")).alias("c")).select("doc_id", F.concat(F.array_join(F.transform("c", lambda c: c["line"]), "\n"), F.lit("\n")).alias("chunks"))
    export_files(names.select("doc_id", "stem").join(texts, "doc_id"), folder, "chunks", "", "chunks.jsonl")


def purge(folder: str | Path, waits: tuple[float, ...] = PURGE_WAITS, remove: Callable[[Path], None] = shutil.rmtree) -> bool:
    """Remove a work folder, trying again after each wait; whether it is gone."""
    folder = Path(folder)
    for wait in waits:
        if wait:
            time.sleep(wait)
        if not folder.exists():
            return True
        try:
            remove(folder)
        except OSError:
            continue
    return not folder.exists()


def rewrite_file(path: str | Path, content: str, apply: bool = False) -> bool:
    """Replace a file's content and keep the old one beside it; without ``apply`` nothing is written."""
    path = Path(path)
    if apply:
        path.with_name(path.name + ".bak").write_bytes(path.read_bytes())
        write_text(path, content)
    return apply


def response(page: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON answer about one page: its image, size, coloured blocks, HTML and markdown, as the column ``body``.

    Needs image_url, width, height, html, markdown and blocks (array of bbox, label and color); the columns ``keep`` stay.
    """
    return page.select(*keep, F.to_json(F.struct(F.col("image_url").alias("image_base64"), F.col("width").alias("image_width"), F.col("height").alias("image_height"), "blocks", "html", "markdown")).alias("body"))
