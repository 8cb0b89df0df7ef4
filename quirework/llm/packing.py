"""Problem 6: filling containers of fixed capacity with documents, by sum-of-squares packing.

Sizes are tokens of a public tokenizer. A document larger than the capacity fills whole windows by itself; only its rest
is packed. All other documents stay whole. Within a block, documents come one by one, and each goes to the fill level
that makes the sum of the squared numbers of partially filled windows per level least. The levels are one array, so a
step costs one pass over the capacity, not over the windows.

Blocks are formed by a hash of the document's key, so that no source or size can make one of them large; they are
packed independently. Windows that are left poorly filled at the end of a block are dissolved, and their documents
are packed again, in fewer blocks of the same size, until one block is left. Every round handles only what the round
before left over.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.session import cut_lineage

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the tokenizer's vocabulary was split into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Items in a block, about.
BLOCK_ITEMS = 50_000
#: Windows filled to a smaller share are dissolved after a round, while there are several blocks.
FULL_SHARE = 0.98
MAX_ROUNDS = 12

SIZES_SCHEMA = "doc_id bigint, n_tokens bigint"
PACKED_SCHEMA = "container_id int, capacity_tokens int, block bigint, window int, doc_id bigint, piece int, start bigint, n_tokens bigint, filled bigint"

_encoders: dict[str, object] = {}


def _encoder(path: str) -> object:
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def token_sizes(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Tokens of every document with text: doc_id, n_tokens. Null and empty texts have no row; repeated rows are kept."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(tokenizer).encode_ordinary
        for part in batches:
            yield pd.DataFrame({"doc_id": part["doc_id"], "n_tokens": [len(encode(t)) for t in part["text"]]})

    return documents.select("doc_id", "text").where("text != ''").mapInPandas(run, SIZES_SCHEMA)


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window of every item, and how full each window is. Sizes are from 1 to ``capacity``."""
    counts = np.zeros(capacity + 1, np.int64)  # counts[h]: windows filled to h, for 0 < h < capacity
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    fill: list[int] = []
    window = np.empty(len(sizes), np.int64)
    for k, size in enumerate(sizes.tolist()):
        if size >= capacity:
            window[k] = len(fill)
            fill.append(capacity)
            continue
        # Change of the sum of squares for level h: the window leaves h and arrives at h + size.
        change = 2 * (counts[size : capacity + 1] - counts[: capacity + 1 - size]) + 2
        change[0] = 2 * counts[size] + 1  # a new window
        change[capacity - size] = 1 - 2 * counts[capacity - size]  # a full one
        usable = counts[: capacity + 1 - size] > 0
        usable[0] = True
        change = np.where(usable, change, np.iinfo(np.int64).max)
        # Of equal changes, the fullest level.
        level = len(change) - 1 - int(change[::-1].argmin())
        if level:
            w = open_at[level].pop()
            counts[level] -= 1
        else:
            w = len(fill)
            fill.append(0)
        fill[w] += size
        if fill[w] < capacity:
            counts[fill[w]] += 1
            open_at[fill[w]].append(w)
        window[k] = w
    return window, np.array(fill, np.int64)


def _items(sizes: DataFrame, containers: DataFrame) -> DataFrame:
    """Pieces of all documents for every container: whole windows of large documents, and one rest or whole document."""
    capacities = containers.select(F.col("container_id").cast("int"), F.col("capacity_tokens").cast("int")).where("container_id is not null and capacity_tokens > 0").distinct()
    per = sizes.where("n_tokens > 0").select("doc_id", "n_tokens").crossJoin(F.broadcast(capacities))  # every container, however many
    pieces = F.sequence(F.lit(0), (F.ceil(F.col("n_tokens") / F.col("capacity_tokens")) - 1).cast("int"))
    exploded = per.select("container_id", "capacity_tokens", "doc_id", F.explode(pieces).alias("piece"), "n_tokens")
    start = F.col("piece").cast("long") * F.col("capacity_tokens")
    return exploded.select("container_id", "capacity_tokens", "doc_id", "piece", start.alias("start"), F.least(F.col("n_tokens") - start, F.col("capacity_tokens").cast("long")).alias("n_tokens"))


def _pack_block(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["order", "doc_id", "piece"], kind="stable")
    window, fill = sum_of_squares(rows["n_tokens"].to_numpy(), int(rows["capacity_tokens"].iloc[0]))
    return rows.assign(window=window, filled=fill[window]).drop(columns="order")[[x.split()[0] for x in PACKED_SCHEMA.split(", ")]]


def pack(sizes: DataFrame, containers: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Windows of every container: container_id, capacity_tokens, block, window, doc_id, piece, start, n_tokens, filled.

    (container_id, block, window) names a window; ``start`` is the piece's first token in its document. Items of size 0
    have no row; of containers without a capacity nothing is made; repeated documents are packed as often as they occur.
    """
    items = _items(sizes, containers)
    done, todo, offset = None, items, 0
    for round_no in range(MAX_ROUNDS):
        todo = cut_lineage(todo)
        most = todo.groupBy("container_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        blocks = int(most // block_items) + 1
        if round_no == MAX_ROUNDS - 1:
            blocks = max(blocks, 1)
        keyed = todo.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", F.lit(round_no)), F.lit(blocks)) + offset).withColumn("order", F.xxhash64("doc_id", "piece"))
        packed = keyed.groupBy("container_id", "block").applyInPandas(_pack_block, PACKED_SCHEMA)
        offset += blocks
        if blocks == 1 or round_no == MAX_ROUNDS - 1:
            return packed if done is None else done.unionByName(packed)
        packed = cut_lineage(packed)
        full = F.col("filled") >= FULL_SHARE * F.col("capacity_tokens")
        kept = packed.where(full)
        done = kept if done is None else done.unionByName(kept)
        todo = packed.where(~full).select("container_id", "capacity_tokens", "doc_id", "piece", "start", "n_tokens")
    raise AssertionError("unreachable")


def fill_rates(packed: DataFrame) -> DataFrame:
    """Windows, items and the share of unused space of every container."""
    windows = packed.groupBy("container_id", "capacity_tokens", "block", "window").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("items"))
    return windows.groupBy("container_id", "capacity_tokens").agg(
        F.count("*").alias("n_windows"), F.sum("items").alias("n_items"), (1 - F.sum("used") / (F.count("*") * F.first("capacity_tokens"))).alias("unused_share")
    )
