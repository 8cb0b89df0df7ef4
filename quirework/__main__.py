"""Command line: process the documents at a path with a page model and a renderer.

    python -m quirework IN OUT --renderer package.module:factory [--method service | --method own --model package.module:factory]
        [--recursive] [--page-range 1-5,7] [--paginate-output] [--no-html] [--include-headers-footers] [--no-images] [--files]
        [--workers N] [--slice-pages N] [--max-output-tokens N] [--max-retries N] [--log-every N] [--log-level LEVEL] [--fail-fast]

OUT holds two tables, artifacts and states, from which a later run knows what is done, and the assembled documents.
States are written before anything is asked of the model, and artifacts slice by slice as they come: a run that is
interrupted keeps all slices it has finished. Exit status: 0 if all is done, 1 if pages are pending or failed, 2 for
wrong input, 130 if interrupted.
"""

from __future__ import annotations

import argparse
import importlib
import logging
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework import config, worker_code
from quirework.functions.ranges import parse_page_range
from quirework.operators import assemble, parse, progress, resume, service
from quirework.plans import pipeline
from quirework.session import cut_lineage
from quirework.sinks import outputs
from quirework.sources import files, pages


def _load(name: str) -> Callable:
    module, _, attribute = name.partition(":")
    if not attribute:
        raise ValueError(f"{name!r} isn't module:factory")
    return getattr(importlib.import_module(module), attribute)


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="quirework", description="Process documents into sanitized HTML, Markdown and chunks.")
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--method", choices=("service", "own"), default="own", help="a service named by the settings, or a model of your own")
    parser.add_argument("--model", help="module:factory of the page model")
    parser.add_argument("--prompt", default="", help="what the service is asked; its wording is the model's")
    parser.add_argument("--renderer", required=True, help="module:factory of the renderer")
    parser.add_argument("--recursive", action=argparse.BooleanOptionalAction, default=False)
    parser.add_argument("--page-range", help="pages, counted from 1, such as 1-5,7")
    parser.add_argument("--paginate-output", "--paginate", dest="paginate", action=argparse.BooleanOptionalAction, default=False, help="put separators between pages")
    parser.add_argument("--html", "--save-html", dest="html", action=argparse.BooleanOptionalAction, default=True, help="write HTML too")
    parser.add_argument("--include-headers-footers", "--headers-footers", dest="headers_footers", action=argparse.BooleanOptionalAction, default=False, help="keep page headers and footers")
    parser.add_argument("--images", "--include-images", dest="images", action=argparse.BooleanOptionalAction, default=True, help="keep images in the text")
    parser.add_argument("--files", action="store_true", help="write one folder of files per document too")
    parser.add_argument("--workers", type=int, help="batches that are asked at a time")
    parser.add_argument("--slice-pages", type=int, default=10_000, help="pages after which what has come is kept")
    parser.add_argument("--max-output-tokens", type=int, help="most tokens of an answer, for a service")
    parser.add_argument("--max-retries", type=int, default=config.load().max_retries)
    parser.add_argument("--log-every", type=int, default=1, help="pages of a book between two lines of progress")
    parser.add_argument("--log-level", choices=("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL"), type=str.upper, default="WARNING")
    parser.add_argument("--fail-fast", action="store_true", help="stop after the first slice with a failed page")
    return parser.parse_args(argv)


def _model_factory(options: argparse.Namespace) -> Callable:
    if options.method == "service":
        return service.service_factory(config.load(), options.prompt, options.max_output_tokens)
    if not options.model:
        raise ValueError("--model names the factory of the page model")
    return _load(options.model)


def process(spark: SparkSession, options: argparse.Namespace) -> int:
    """One run; its exit status."""
    wanted = F.array(*map(F.lit, parse_page_range(options.page_range))) if options.page_range else None
    model_factory, renderer_factory = _model_factory(options), _load(options.renderer)
    found = files.discover(spark, options.input, options.recursive)
    artifact_table, state_table = f"{options.output}/artifacts", f"{options.output}/states"
    contents = spark.read.format("binaryFile").option("recursiveFileLookup", str(options.recursive).lower()).load(options.input).select("path", "content")
    with_content = found.select("doc_id", "path").join(contents, "path").select("doc_id", "content")
    counted = pages.count_pages(with_content, renderer_factory).where("total_pages is not null")
    documents = cut_lineage(found.join(counted, "doc_id"))
    expected = resume.plan_pages(documents, wanted)

    earlier = pipeline.stored(spark, state_table)
    run_no = ((earlier.agg(F.max("run_no")).first()[0] or 0) if earlier is not None else 0) + 1
    planned = expected.groupBy("doc_id").agg(F.array_sort(F.collect_set("page_num")).alias("planned"))
    outputs.append_states(outputs.state_rows(documents.join(planned, "doc_id"), run_no, F.col("planned")), state_table)
    matches = cut_lineage(resume.fingerprints(found, pipeline.stored(spark, state_table)))

    def current(done: DataFrame) -> DataFrame:
        return resume.drop_stale(done, matches)

    books = progress.book_numbers(documents).join(documents.select("doc_id", "stem"), "doc_id")
    totals = expected.groupBy("doc_id").agg(F.count("*").alias("total"))
    known = pipeline.stored(spark, artifact_table)
    before = resume.completeness(expected, current(known)).select("doc_id", F.col("n_done").alias("already_done")) if known is not None else None
    counts = totals.join(before, "doc_id", "left") if before is not None else totals.withColumn("already_done", F.lit(0))
    for part in pipeline.run_slices(
        documents, lambda keys: pages.render_pages(with_content, keys, renderer_factory).where("not error").drop("error", "error_message"), artifact_table, model_factory, wanted, current,
        options.slice_pages, options.workers, options.headers_footers, options.images, run_no, max_retries=options.max_retries,
    ):
        done = part.pages.withColumn("finished_at", F.current_timestamp())
        for row in progress.lines(progress.page_progress(done, counts, options.log_every), books).orderBy("doc_id", "page_num").toLocalIterator():
            print(row["line"])
        if options.fail_fast and (failed := part.pages.where("error").count()):
            print(f"stopped: {failed} pages failed in slice {part.number} of {part.total}")
            break
        if part.number < part.total:
            here = part.pages.groupBy("doc_id").agg(F.count("*").alias("n"))
            counts = cut_lineage(counts.join(here, "doc_id", "left").select("doc_id", "total", (F.coalesce("already_done", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("already_done")))
    artifacts = pipeline.stored(spark, artifact_table)
    artifacts = current(artifacts).drop("run_no") if artifacts is not None else spark.createDataFrame([], parse.ARTIFACT_SCHEMA)
    status = resume.completeness(expected, artifacts)
    complete = status.where("complete").select("doc_id")
    names = documents.select("doc_id", "stem", F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"))
    finished = artifacts.join(complete, "doc_id", "left_semi")
    outputs.write_documents(finished, names, f"{options.output}/documents", options.paginate, options.html)
    if options.files:
        outputs.export_documents(finished, names, f"{options.output}/files", options.paginate, options.html)
    statistics = assemble.run_statistics(status, artifacts)
    row = statistics.first()
    print(f"{row['books']} documents: {row['pages_processed']} pages done, {row['pages_pending']} pending, {row['pages_failed']} failed")
    return pipeline.exit_code(statistics)


def main(argv: list[str] | None = None) -> int:
    options = _arguments(argv)
    spark = SparkSession.builder.appName("quirework").getOrCreate()
    logging.basicConfig(level=options.log_level)
    worker_code.ship(spark)
    try:
        return process(spark, options)
    except ValueError as error:
        print(f"quirework: {error}", file=sys.stderr)
        return 2
    except KeyboardInterrupt:
        return 130


if __name__ == "__main__":
    sys.exit(main())
