"""Documents as a stream: pages come in any order, and each document is complete when the last page it expects is there.

State is held per part of ``PART_PAGES`` page numbers of a document: a bitmap of the expected pages that have come and
two numbers, never texts, so its size is bounded and a large document is spread over many keys. A part is emitted once,
when all its expected pages are there. A document is complete when all its parts are; that is asked of the parts
emitted so far, a table that only grows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

PART_PAGES = 4096
#: With a time column, state that hears nothing for so long is dropped: the mark of an emitted part, and a part that
#: never gets complete.
KEEP_MS = 7 * 24 * 3600 * 1000
PARTS_SCHEMA = "doc_id string, part int, n_pages int, n_failed int, total_token_count bigint"
COMPLETE_SCHEMA = "doc_id string, n_pages bigint, n_failed bigint, total_token_count bigint"
_STATE_SCHEMA = "seen binary, n_seen int, n_failed int, tokens bigint, emitted boolean"


def read_artifacts(spark: SparkSession, folder: str, schema: StructType | str, files_per_batch: int = 16) -> DataFrame:
    """Stream of artifacts appended to a folder; ``files_per_batch`` bounds how much is taken at once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def _parted(pages: DataFrame) -> DataFrame:
    return pages.withColumn("part", F.floor(F.col("page_num") / PART_PAGES).cast("int"))


def expected_parts(expected: DataFrame) -> DataFrame:
    """Expected pages by part: doc_id, part, n_expected. ``expected`` has doc_id and page_num."""
    return _parted(expected.select("doc_id", "page_num").where("page_num is not null").distinct()).groupBy("doc_id", "part").agg(F.count("*").alias("n_expected"))


def complete_parts(pages: DataFrame, expected: DataFrame, time: str | None = None, keep_ms: int = KEEP_MS) -> DataFrame:
    """Each part of a document once, when all its expected pages have come: doc_id, part, n_pages, n_failed, total_token_count.

    ``expected`` is static: doc_id, page_num. Pages that aren't expected, and pages that come again, change nothing.
    ``time`` names the column of the pages' times, by which state ends ``keep_ms`` after its last page; without it, the
    bitmap of an emitted part ends and a mark stays.
    """
    wanted = _parted(expected.select("doc_id", "page_num").where("page_num is not null").distinct()).join(expected_parts(expected), ["doc_id", "part"])
    keyed = pages.where("page_num is not null").select("doc_id", "page_num", F.coalesce("token_count", F.lit(0)).alias("token_count"), F.coalesce("error", F.lit(False)).alias("error"), *([F.col(time).alias("_time")] if time else []))
    if time:
        keyed = keyed.withWatermark("_time", f"{keep_ms} milliseconds")
    keyed = keyed.join(wanted, ["doc_id", "page_num"])

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held, n_seen, n_failed, tokens, emitted = state.get if state.exists else (bytes(PART_PAGES // 8), 0, 0, 0, False)
        seen, needed = bytearray(held), 0
        for part in batches:
            for number, count, error, n in zip(part["page_num"], part["token_count"], part["error"], part["n_expected"]):
                needed = int(n)
                byte, bit = divmod(int(number) % PART_PAGES, 8)
                if emitted or seen[byte] >> bit & 1:
                    continue
                seen[byte] |= 1 << bit
                n_seen, n_failed, tokens = n_seen + 1, n_failed + bool(error), tokens + int(count)
        if not emitted and needed and n_seen >= needed:
            yield pd.DataFrame([(*key, n_seen, n_failed, tokens)], columns=["doc_id", "part", "n_pages", "n_failed", "total_token_count"])
            emitted, seen = True, bytearray()
        state.update((bytes(seen), n_seen, n_failed, tokens, emitted))
        if time:
            state.setTimeoutTimestamp(state.getCurrentWatermarkMs() + keep_ms)

    ends = GroupStateTimeout.EventTimeTimeout if time else GroupStateTimeout.NoTimeout
    return keyed.groupBy("doc_id", "part").applyInPandasWithState(step, PARTS_SCHEMA, _STATE_SCHEMA, "append", ends)


def complete_documents(parts: DataFrame, expected: DataFrame) -> DataFrame:
    """Documents all of whose expected parts have been emitted: doc_id, n_pages, n_failed, total_token_count.

    Parts that were written twice, as after a restart in the middle of a write, count once.
    """
    needed = expected_parts(expected).groupBy("doc_id").agg(F.count("*").alias("n_parts"))
    done = parts.dropDuplicates(["doc_id", "part"]).groupBy("doc_id").agg(F.count("*").alias("n_done"), *[F.sum(c).alias(c) for c in ("n_pages", "n_failed", "total_token_count")])
    return done.join(needed, "doc_id").where("n_done = n_parts").select("doc_id", "n_pages", "n_failed", "total_token_count")


def drain(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, timeout: float | None = None) -> None:
    """Take all that is there, batch by batch, and stop; started again with the same checkpoint it goes on after it."""
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        if not query.awaitTermination(timeout) and timeout is not None:
            raise TimeoutError(f"the stream isn't drained after {timeout} seconds")
    finally:
        if query.isActive:
            query.stop()


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per type and window of event time, late ones taken in as long as the watermark allows."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    counted = timed.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), "event_type", "n")
