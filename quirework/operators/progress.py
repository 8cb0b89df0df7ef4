"""Progress of a run as rows: how many pages of a book were done when each page was."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.operators.ordinals import global_number, running_number


def book_numbers(documents: DataFrame) -> DataFrame:
    """Books numbered from 1 by path: doc_id, path, book_no, n_books."""
    books = documents.groupBy("doc_id").agg(F.min("path").alias("path"))
    numbered = global_number(books, ["path", "doc_id"], "book_no")
    return numbered.withColumn("n_books", F.lit(numbered.count()).cast("bigint"))


def page_progress(done: DataFrame, totals: DataFrame, every: int = 1) -> DataFrame:
    """Running count of done pages per book, and the pages at which it is reported.

    ``done``: doc_id, page_num, finished_at, error; ``totals``: doc_id, total, already_done. A page is reported if the
    count is a multiple of ``every`` or the book is complete. Pages without a time come first.
    """
    step = max(1, every)
    numbered = running_number(done, ["doc_id"], F.date_trunc("hour", F.col("finished_at")), [F.col("finished_at").asc_nulls_first(), "page_num"], "_n")
    joined = numbered.join(totals, "doc_id", "left").withColumn("n_done", F.col("_n") + F.coalesce("already_done", F.lit(0))).drop("_n")
    return joined.withColumn("reported", (F.col("n_done") % step == 0) | F.coalesce(F.col("n_done") == F.col("total"), F.lit(False)))


def lines(progress: DataFrame, books: DataFrame) -> DataFrame:
    """The lines that a run prints: doc_id, page_num, line."""
    joined = progress.where("reported").join(books, "doc_id", "left")
    text = F.format_string(
        "  Book # %d of %d, %s, Page # %d of %d%s", "book_no", "n_books", "stem", F.col("page_num") + 1, "total", F.when(F.coalesce("error", F.lit(False)), " ERR").otherwise("")
    )
    return joined.select("doc_id", "page_num", text.alias("line"))
