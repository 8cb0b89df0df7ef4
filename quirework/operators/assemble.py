"""Merging page artifacts into documents.

Documents may be of any size. Pages are first merged into parts of ``PART_PAGES`` consecutive page numbers, so no task
holds more than that many pages of one document; the ordinal of a page, which the separators show, is its place in the
part plus the number of pages of the earlier parts. A document is its parts in order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART_PAGES = 2000
SEPARATOR = "\n\n"
RULE = "-" * 48


def one_per_page(artifacts: DataFrame, values: dict[str, Column] | None = None) -> DataFrame:
    """One artifact of each page: a good one before a failed one, then the one with the most tokens and the longest text.

    With ``values``, only these columns come out; they are computed before the shuffle, so that what they don't need
    isn't moved. Texts are compared by length and hash.
    """
    rank = F.struct(~F.coalesce("error", F.lit(False)), F.coalesce("token_count", F.lit(0)), F.length("markdown"), F.md5("markdown"))
    carried = values if values is not None else {c: F.col(c) for c in artifacts.columns if c not in ("doc_id", "page_num")}
    ranked = artifacts.select("doc_id", "page_num", rank.alias("_rank"), F.struct(*[c.alias(n) for n, c in carried.items()]).alias("_p"))
    return ranked.groupBy("doc_id", "page_num").agg(F.max_by("_p", "_rank").alias("_p")).select("doc_id", "page_num", "_p.*")


def _separated(text: str, paginated: Callable | None) -> Callable:
    def one(page: Column, i: Column, offset: Column) -> Column:
        ordinal = i + offset
        gap = paginated(ordinal) if paginated else F.lit(SEPARATOR)
        return F.when(ordinal == 0, F.coalesce(page[text], F.lit(""))).otherwise(F.concat(gap, F.coalesce(page[text], F.lit(""))))

    return one


def _markdown_rule(ordinal: Column) -> Column:
    return F.concat(F.lit(SEPARATOR), ordinal.cast("string"), F.lit(RULE + SEPARATOR))


def _html_rule(ordinal: Column) -> Column:
    return F.concat(F.lit(SEPARATOR + "<!-- Page "), (ordinal + 1).cast("string"), F.lit(" -->" + SEPARATOR))


def assemble_parts(artifacts: DataFrame, paginated: bool = False, part_pages: int = PART_PAGES) -> DataFrame:
    """Parts of each document: doc_id, part, n_pages, markdown, html. Null texts count as empty."""
    texts = one_per_page(artifacts, {c: F.col(c) for c in ("markdown", "html_filtered")})
    pages = texts.where("page_num is not null").select("doc_id", F.floor(F.col("page_num") / part_pages).cast("int").alias("part"), F.struct("page_num", "markdown", "html_filtered").alias("page"))
    grouped = pages.groupBy("doc_id", "part").agg(F.array_sort(F.collect_list("page")).alias("pages"))
    before = Window.partitionBy("doc_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = grouped.withColumn("_offset", F.coalesce(F.sum(F.size("pages")).over(before), F.lit(0)).cast("int"))

    def joined(text: str, rule: Callable) -> Column:
        one = _separated(text, rule if paginated else None)
        return F.array_join(F.transform("pages", lambda p, i: one(p, i, F.col("_offset"))), "")

    return placed.select("doc_id", "part", F.size("pages").alias("n_pages"), joined("markdown", _markdown_rule).alias("markdown"), joined("html_filtered", _html_rule).alias("html"))


def assemble(artifacts: DataFrame, paginated: bool = False) -> DataFrame:
    """Whole documents in one value each: doc_id, num_pages, markdown, html. For documents that fit a value (2 GB)."""
    parts = assemble_parts(artifacts, paginated)
    whole = parts.groupBy("doc_id").agg(F.sum("n_pages").alias("num_pages"), F.array_sort(F.collect_list(F.struct("part", "markdown", "html"))).alias("parts"))
    text = lambda name: F.array_join(F.transform("parts", lambda p: p[name]), "")
    return whole.select("doc_id", "num_pages", text("markdown").alias("markdown"), text("html").alias("html"))


def document_chunks(artifacts: DataFrame) -> DataFrame:
    """Chunks of all pages with their place: doc_id, page_num, position, and the chunk's fields."""
    pages = one_per_page(artifacts, {"chunks": F.col("chunks")})
    return pages.select("doc_id", "page_num", F.posexplode("chunks").alias("position", "c")).select("doc_id", "page_num", "position", "c.*")


def page_metadata(artifacts: DataFrame) -> DataFrame:
    """Metadata of every page: tokens, chunks and images, nulls counted as none."""
    size = lambda name: F.coalesce(F.array_size(name), F.lit(0))
    return one_per_page(
        artifacts,
        {
            "page_box": F.col("page_box"), "token_count": F.coalesce("token_count", F.lit(0)), "num_chunks": size("chunks"),
            "num_images": size("image_files"), "error": F.col("error"),
        },
    )


def document_metadata(artifacts: DataFrame) -> DataFrame:
    """Totals of each document; sums are combined before the shuffle."""
    return page_metadata(artifacts).groupBy("doc_id").agg(
        F.count("*").alias("num_pages"), F.sum("token_count").alias("total_token_count"), F.sum("num_chunks").alias("total_chunks"),
        F.sum("num_images").alias("total_images"), F.count_if(F.coalesce("error", F.lit(False))).alias("failed_pages"),
    )


def metadata_json(artifacts: DataFrame, names: DataFrame) -> DataFrame:
    """Metadata of each document as one JSON value: doc_id, metadata. ``names``: doc_id, file_name.

    For documents whose pages fit a value; :func:`page_metadata` has rows for any size.
    """
    pages = page_metadata(artifacts).groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("page_num", "page_box", "token_count", "num_chunks", "num_images", "error"))).alias("pages")
    )
    joined = pages.join(names.select("doc_id", "file_name").distinct(), "doc_id", "left")
    total = lambda name: F.aggregate("pages", F.lit(0).cast("bigint"), lambda acc, p: acc + p[name])
    body = F.struct("file_name", F.size("pages").alias("num_pages"), total("token_count").alias("total_token_count"), total("num_chunks").alias("total_chunks"), total("num_images").alias("total_images"), "pages")
    return joined.select("doc_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("metadata"))


def run_statistics(completeness: DataFrame, artifacts: DataFrame) -> DataFrame:
    """One row about a run: books, pages_processed, pages_pending, pages_failed."""
    expected = completeness.select(F.lit(1).alias("books"), F.col("n_done").alias("pages_processed"), (F.col("n_expected") - F.col("n_done")).alias("pages_pending"), F.lit(0).alias("pages_failed"))
    failed = one_per_page(artifacts, {"error": F.col("error")}).where("error").select(F.lit(0).alias("books"), F.lit(0).alias("pages_processed"), F.lit(0).alias("pages_pending"), F.lit(1).alias("pages_failed"))
    both = expected.unionByName(failed)
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in both.columns])
