"""The boundary to a page model.

No recognition model ships with this engine. A model is anything that answers a batch of requests; it runs inside
``mapInPandas``, is built once per worker, and its failures are rows. Answers are asked for again by the retry rules.
Materialize what :func:`generate` returns before using it twice, since evaluating it again asks the model again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions.repeats import is_degenerate, is_loop
from quirework.functions.serving import RETRY_MOST, RETRY_STEP, RETRY_TOP_P, should_retry

ANSWER_SCHEMA = "raw string, token_count int, error boolean, error_kind string, attempts int"
NOT_RETRYABLE = frozenset(("auth", "http_4xx"))


class PageModel(Protocol):
    """Answers requests: a frame with raw, token_count, error and error_kind, in the order of the requests."""

    def generate(self, requests: pd.DataFrame, temperature: float, top_p: float) -> pd.DataFrame: ...


_models: dict[object, PageModel] = {}


def _worker_model(key: object, factory: Callable[[], PageModel]) -> PageModel:
    """The model of this worker process, built at its first use; the one of an earlier run gives way."""
    if key not in _models:
        _models.clear()
        _models[key] = factory()
    return _models[key]


def _ask(model: PageModel, requests: pd.DataFrame, temperature: float, top_p: float) -> pd.DataFrame:
    try:
        answers = model.generate(requests, temperature, top_p).reset_index(drop=True)
        if len(answers) != len(requests):
            raise ValueError(f"{len(answers)} answers to {len(requests)} requests")
    except Exception:  # noqa: BLE001 - a failed batch is failed rows
        answers = pd.DataFrame({"raw": [""] * len(requests), "token_count": 0, "error": True, "error_kind": "unknown"})
    answers["error"] = answers["error"].fillna(False).astype(bool) | answers["raw"].isna()
    answers["raw"] = answers["raw"].fillna("")
    return answers


def answer_batch(model: PageModel, requests: pd.DataFrame, max_retries: int, max_failures: int, temperature: float, top_p: float, honour_class: bool = True, wait: Callable[[float], None] = time.sleep) -> pd.DataFrame:
    """Answers to a batch after retries, in order.

    Only requests whose answer is degenerate or failed are asked again, with a rising temperature. With
    ``honour_class``, failures that can't pass by themselves are not.
    """
    answers = _ask(model, requests, temperature, top_p)
    answers["attempts"] = 1
    retries = 0
    while True:
        loops = answers["raw"].map(is_loop) & (retries < max_retries)
        failed = answers["error"] & (retries < max_failures)
        if honour_class:
            failed &= ~answers["error_kind"].isin(NOT_RETRYABLE)
        again = (loops | failed).to_numpy()
        if not again.any():
            return answers
        if failed.any():
            wait(2 * (retries + 1))
        retries += 1
        new = _ask(model, requests[again].reset_index(drop=True), min(temperature + RETRY_STEP * retries, RETRY_MOST), RETRY_TOP_P)
        new["attempts"] = retries + 1
        for column in ("raw", "token_count", "error", "error_kind", "attempts"):
            answers.loc[again, column] = new[column].to_numpy()


def generate(pages: DataFrame, factory: Callable[[], PageModel], max_retries: int = 6, max_failures: int | None = None, temperature: float = 0.0, top_p: float = 0.1, honour_class: bool = True) -> DataFrame:
    """``pages`` with the model's answer: raw, token_count, error, error_kind, attempts. Keys travel with their rows."""
    names = pages.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema) + ", " + ANSWER_SCHEMA
    failures = max_retries if max_failures is None else max_failures
    key = uuid.uuid4().hex  # names this call, so that no other factory's model is taken for its

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _worker_model(key, factory)
        for part in batches:
            if len(part):
                answers = answer_batch(model, part, max_retries, failures, temperature, top_p, honour_class)
                yield pd.concat([part[names].reset_index(drop=True), answers[["raw", "token_count", "error", "error_kind", "attempts"]]], axis=1)

    return pages.mapInPandas(run, schema)


# The two kinds of request. Their wording is the caller's.
PROMPT_TYPES = ("ocr_layout", "ocr")


def prompt(own: Column, kind: Column, prompts: dict[str, str]) -> Column:
    """A request's own prompt, or the one of its kind; an unknown kind ends the query."""
    table = F.create_map(*[F.lit(x) for pair in prompts.items() for x in pair])
    known = F.try_element_at(table, kind)
    return F.coalesce(F.nullif(own, F.lit("")), known, F.raise_error(F.concat(F.lit("no prompt of kind "), F.coalesce(kind, F.lit("null")))).cast("string"))


def message(prompt_text: Column, image_url: Column) -> Column:
    """A request as the struct that services take: the image, then the prompt."""
    image = F.struct(F.lit("image_url").alias("type"), F.struct(image_url.alias("url")).alias("image_url"), F.lit(None).cast("string").alias("text"))
    text = F.struct(F.lit("text").alias("type"), F.lit(None).cast("struct<url: string>").alias("image_url"), prompt_text.alias("text"))
    return F.struct(F.lit("user").alias("role"), F.array(image, text).alias("content"))


def retry_decisions(results: DataFrame, max_retries: int = 6) -> DataFrame:
    """What the retry rules say about recorded calls: request_id, degenerate, retry. Repeated rows count once."""
    calls = results.select("request_id", "attempt", "raw", "error").distinct()
    judged = calls.withColumn("degenerate", is_degenerate(F.col("raw")))
    return judged.select("request_id", "degenerate", should_retry(F.col("degenerate"), F.col("error"), F.col("attempt") - 1, max_retries).alias("retry"))


def accepted_calls(results: DataFrame) -> DataFrame:
    """The recorded call that became each page: the last attempt. One row per page."""
    best = results.groupBy("doc_id", "page_num").agg(F.max_by(F.struct("request_id", "raw", "token_count", "error", "error_kind"), F.struct("attempt", "request_id")).alias("c"))
    return best.select("doc_id", "page_num", "c.*")


def attempts_per_page(results: DataFrame) -> DataFrame:
    """Distinct calls of each page and how many of them failed."""
    calls = results.select("doc_id", "page_num", "request_id", "error").distinct()
    return calls.groupBy("doc_id", "page_num").agg(F.count("*").alias("n_calls"), F.count_if(F.coalesce("error", F.lit(False))).alias("n_failed"))


__all__ = ["PageModel", "accepted_calls", "answer_batch", "attempts_per_page", "generate", "message", "prompt", "retry_decisions"]
