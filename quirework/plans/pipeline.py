"""Whole runs: from documents to artifacts and assembled documents, in batch."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.operators import assemble, labels, model, parse, resume
from quirework.session import cut_lineage


@dataclass
class Run:
    """What a run leaves: all artifacts, the new ones among them, the documents' completeness, and statistics."""

    artifacts: DataFrame
    new: DataFrame
    completeness: DataFrame
    statistics: DataFrame


def run(documents: DataFrame, pages: DataFrame, done: DataFrame | None, factory: Callable[[], model.PageModel], page_range: Column | None = None, headers_footers: bool = False, images: bool = True, **options: object) -> Run:
    """Process what is pending of ``documents`` and merge it with what is ``done``.

    ``documents``: doc_id, stem, total_pages. ``pages``: doc_id, page_num, width, height and whatever the model takes.
    ``done``: earlier artifacts or null. Pages that have an artifact aren't asked for again; pages that ``pages`` lacks
    become error rows. The answers are materialized once, in the shared checkpoint folder, before they are used.
    """
    expected = resume.plan_pages(documents, page_range)
    pending = resume.pending_pages(expected, done) if done is not None else expected
    todo = pages.join(pending, ["doc_id", "page_num"], "left_semi").join(documents.select("doc_id", "stem"), "doc_id", "left")
    answered = model.generate(todo, factory, **options)
    message = F.when(F.col("error"), F.concat(F.coalesce("error_kind", F.lit("unknown")), F.lit(": the model gave no answer")))
    new = cut_lineage(parse.parse_pages(answered.withColumn("error_message", message), headers_footers, images))
    lost = resume.missing_as_errors(pending.join(new.select("doc_id", "page_num"), ["doc_id", "page_num"], "left_anti"))
    added = new.unionByName(lost, allowMissingColumns=True)
    artifacts = done.unionByName(added, allowMissingColumns=True) if done is not None else added
    status = resume.completeness(expected, artifacts)
    return Run(artifacts, added, status, assemble.run_statistics(status, artifacts))


@dataclass
class Slice:
    """What one slice of a run has appended."""

    number: int
    total: int
    pages: DataFrame


def run_slices(
    documents: DataFrame, pages_of: Callable[[DataFrame], DataFrame], table: str, factory: Callable[[], model.PageModel], page_range: Column | None = None,
    current: Callable[[DataFrame], DataFrame] | None = None, slice_pages: int = 10_000, workers: int | None = None, headers_footers: bool = False, images: bool = True, run_no: int = 1, **options: object,
) -> Iterator[Slice]:
    """Process what is pending of ``documents``, slice by slice; each slice is in ``table`` before the next is begun.

    ``pages_of`` gives the pages that a frame of keys names, with whatever the model takes; it is asked once for every
    slice, so that pages are rendered when they are needed. ``current`` drops artifacts of changed sources. A run that
    dies loses the slice it was at; run again, it goes on after the last one appended. Slices are made by a hash of the
    page's key, of about ``slice_pages`` pages, which should be many times the cluster's tasks. ``workers`` is how many
    batches are asked at a time. Artifacts carry ``run_no``, by which they are held against the state of their run.
    """
    spark = documents.sparkSession
    expected = resume.plan_pages(documents, page_range)
    done = stored(spark, table)
    if done is not None and current is not None:
        done = current(done)
    pending = cut_lineage(resume.pending_pages(expected, done) if done is not None else expected)
    total = max(1, math.ceil(pending.count() / slice_pages))
    place = F.pmod(F.xxhash64("doc_id", "page_num"), F.lit(total))
    message = F.when(F.col("error"), F.concat(F.coalesce("error_kind", F.lit("unknown")), F.lit(": the model gave no answer")))
    for number in range(total):
        wanted = pending.where(place == number)
        todo = pages_of(wanted).join(documents.select("doc_id", "stem"), "doc_id", "left")
        answered = model.generate(todo.repartition(workers) if workers else todo, factory, **options)
        new = cut_lineage(parse.parse_pages(answered.withColumn("error_message", message), headers_footers, images))
        lost = resume.missing_as_errors(wanted.join(new.select("doc_id", "page_num"), ["doc_id", "page_num"], "left_anti"))
        added = new.unionByName(lost, allowMissingColumns=True)
        added.withColumn("run_no", F.lit(run_no)).write.mode("append").parquet(table)
        yield Slice(number + 1, total, added.select("doc_id", "page_num", "error"))


def stored(spark: SparkSession, table: str) -> DataFrame | None:
    """A table of an earlier run, or null."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    exists = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return spark.read.parquet(table) if exists else None


def one_page(page: DataFrame, factory: Callable[[], model.PageModel]) -> DataFrame:
    """Artifacts of single pages with coloured blocks, for an answer to a request: no state, no resuming."""
    answered = model.generate(page, factory)
    parsed = parse.parse_pages(answered)
    palette = F.create_map(*[F.lit(x) for pair in labels.COLOURS.items() for x in pair])
    blocks = F.transform("chunks", lambda c: F.struct(c["bbox"].alias("bbox"), c["label"].alias("label"), F.coalesce(F.try_element_at(palette, c["label"]), F.lit(labels.DEFAULT_COLOUR)).alias("color")))
    return parsed.withColumn("blocks", blocks)


def exit_code(statistics: DataFrame) -> int:
    """0 if everything was done without a failed page, else 1."""
    row = statistics.first()
    return int(bool(row["pages_pending"] or row["pages_failed"]))
