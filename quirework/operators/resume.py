"""What has been done, what is stale, and what is left to do.

Documents are named by ``doc_id``. Nothing here writes: a run appends its state and artifacts, and these operators
derive from the tables which pages are pending. Joins carry keys only; texts never take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions.ranges import selected

#: Modification times of the same file differ by less than this many seconds.
MTIME_TOLERANCE = 1.0


def same_source(size: Column, mtime: Column, known_size: Column, known_mtime: Column) -> Column:
    """Whether a file is the one a state was recorded for: equal size, time within the tolerance. Unknown is not."""
    return F.coalesce((size == known_size) & (F.abs(mtime - known_mtime) < MTIME_TOLERANCE), F.lit(False))


def latest_state(run_state: DataFrame) -> DataFrame:
    """The last recorded run of each document: doc_id, run_no, path, size, mtime, expected_pages."""
    last = run_state.groupBy("doc_id").agg(F.max_by(F.struct("run_no", "source", "expected_pages"), F.struct("run_no", F.size("expected_pages"))).alias("s"))
    return last.select("doc_id", "s.run_no", F.col("s.source.path").alias("path"), F.col("s.source.size").alias("size"), F.col("s.source.mtime").alias("mtime"), "s.expected_pages")


def fingerprints(source_files: DataFrame, run_state: DataFrame) -> DataFrame:
    """Whether each recorded run is of the file as it is now: doc_id, run_no, matches. Runs without a file don't match."""
    files = source_files.select("doc_id", F.col("length").alias("_size"), F.unix_micros("modification_time").alias("_micros")).distinct()
    states = run_state.select("doc_id", "run_no", F.col("source.size").alias("_known_size"), F.col("source.mtime").alias("_known_mtime")).distinct()
    match = same_source(F.col("_size"), F.col("_micros") / 1e6, F.col("_known_size"), F.col("_known_mtime"))
    return states.join(files, "doc_id", "left").groupBy("doc_id", "run_no").agg(F.max(match).alias("matches"))


def expected_pages(run_state: DataFrame) -> DataFrame:
    """One row per page that any recorded run expects: doc_id, page_num."""
    return run_state.select("doc_id", F.explode("expected_pages").alias("page_num")).distinct()


def plan_pages(documents: DataFrame, page_range: Column | None = None) -> DataFrame:
    """Pages to process of each document: those of the range that exist, or all. Needs doc_id and total_pages.

    The range is held against the document's full number of pages, so a range that begins late loses nothing.
    """
    wanted = selected(page_range if page_range is not None else F.lit(None).cast("array<int>"), F.col("total_pages"))
    return documents.select("doc_id", F.explode(wanted).alias("page_num")).distinct()


def done_pages(artifacts: DataFrame) -> DataFrame:
    """Keys of the pages that have an artifact."""
    return artifacts.select("doc_id", "page_num").where("page_num is not null").distinct()


def pending_pages(expected: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Expected pages without an artifact."""
    return expected.join(done_pages(artifacts), ["doc_id", "page_num"], "left_anti")


def completeness(expected: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Expected, present and missing pages of each document: doc_id, n_expected, n_done, complete."""
    done = done_pages(artifacts).withColumn("_done", F.lit(1))
    return (
        expected.join(done, ["doc_id", "page_num"], "left").groupBy("doc_id")
        .agg(F.count("*").alias("n_expected"), F.count("_done").alias("n_done"))
        .withColumn("complete", F.col("n_expected") == F.col("n_done"))
    )


def unfinished(documents: DataFrame, finished: DataFrame) -> DataFrame:
    """Documents without finished, non-empty output of the same source; ``finished``: doc_id, size, mtime, n_chars."""
    usable = finished.where("n_chars > 0").select("doc_id", F.col("size").alias("_size"), F.col("mtime").alias("_mtime"))
    same = (documents["doc_id"] == usable["doc_id"]) & (documents["size"] == usable["_size"]) & (F.abs(documents["mtime"] - usable["_mtime"]) < MTIME_TOLERANCE)
    return documents.join(usable, same, "left_anti")


def drop_stale(artifacts: DataFrame, matches: DataFrame) -> DataFrame:
    """Artifacts but for those of sources that have changed.

    Artifacts with a run_no are held against the state of their own run; others stay if any recorded run of the
    document is of the file as it is now.
    """
    if "run_no" in artifacts.columns:
        return artifacts.join(matches.where("matches").select("doc_id", "run_no").distinct(), ["doc_id", "run_no"], "left_semi")
    current = matches.groupBy("doc_id").agg(F.max("matches").alias("current")).where("current")
    return artifacts.join(current.select("doc_id"), "doc_id", "left_semi")


def missing_as_errors(pending: DataFrame) -> DataFrame:
    """Pages that never came, as error rows: a failed rendering doesn't leave a gap."""
    return pending.select("doc_id", "page_num", F.lit(True).alias("error"), F.lit("MissingPage: the page was never rendered").alias("error_message"))
