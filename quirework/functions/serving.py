"""Rules of the page model's service: limits, retries and error classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Memory of accelerators in GB, and the limits of the one with BASE_VRAM.
VRAM_GB = {"h100": 80, "a100-80": 80, "a100": 40, "a100-40": 40, "l40s": 48, "a10": 24, "l4": 24, "4090": 24, "3090": 24, "t4": 16}
BASE_VRAM, BASE_TOKENS, BASE_SEQUENCES = 80, 8192, 64
MIN_TOKENS, MIN_SEQUENCES = 1024, 8

RETRY_STEP, RETRY_MOST, RETRY_TOP_P, FIRST_TOP_P = 0.2, 0.8, 0.95, 0.1


def vram(gpu: Column) -> Column:
    """Memory of an accelerator, null if it is unknown."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in VRAM_GB.items() for x in pair]), gpu)


def batched_tokens(memory: Column) -> Column:
    """Tokens per batch: the power of two at or below the share of memory, within the least."""
    return F.greatest(F.lit(MIN_TOKENS), F.pow(F.lit(2.0), F.floor(F.log2(memory * (BASE_TOKENS / BASE_VRAM)))).cast("int"))


def sequences(memory: Column) -> Column:
    """Sequences at once: a multiple of eight by the share of memory, within the least."""
    return F.greatest(F.lit(MIN_SEQUENCES), (F.floor(F.floor(memory * (BASE_SEQUENCES / BASE_VRAM)) / 8) * 8).cast("int"))


def retry_temperature(first: Column, retries: Column) -> Column:
    """Temperature of the attempt after ``retries`` retries; the first attempt keeps its own."""
    return F.when(retries == 0, first).otherwise(F.least(first + RETRY_STEP * retries, F.lit(RETRY_MOST)))


def retry_top_p(retries: Column) -> Column:
    return F.when(retries == 0, FIRST_TOP_P).otherwise(RETRY_TOP_P)


def backoff_seconds(retries: Column) -> Column:
    """Wait before the retry that follows ``retries`` others."""
    return 2 * (retries + 1)


def error_class(kind: Column, status: Column) -> Column:
    """Class of an error by the kind of exception and the status of the answer; timeouts go before connections."""
    return (
        F.when(kind == "AuthenticationError", "auth").when(kind == "RateLimitError", "rate_limit").when(kind == "APITimeoutError", "timeout")
        .when(kind == "APIConnectionError", "connection").when(kind == "APIStatusError", F.concat(F.lit("http_"), F.coalesce(status.cast("string"), F.lit("unknown"))))
        .otherwise("unknown")
    )


def is_retryable(error: Column) -> Column:
    """Whether an error of a class may pass by itself: not a refused login, nor an answer below 500."""
    status = F.regexp_extract(error, r"^http_(\d+)$", 1).try_cast("int")
    return F.when(error == "auth", False).when(error.startswith("http_"), F.coalesce(status.between(500, 599), error == "http_5xx")).otherwise(True)


def should_retry(degenerate: Column, error: Column, retries: Column, max_retries: int = 6, max_failures: int | None = None) -> Column:
    """Whether to ask again: for degenerate answers and for errors, each within its own number of retries."""
    failures = max_retries if max_failures is None else max_failures
    return (F.coalesce(degenerate, F.lit(False)) & (retries < max_retries)) | (F.coalesce(error, F.lit(False)) & (retries < failures))
