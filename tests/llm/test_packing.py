from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quirework.llm import packing as pk


def slow(sizes, capacity):
    """Every step by comparing the sum of squares of all choices."""
    fills, window = [], []
    for size in sizes:
        if size >= capacity:
            fills.append(capacity)
            window.append(len(fills) - 1)
            continue

        def cost(fills):
            counts = defaultdict(int)
            for f in fills:
                if f < capacity:
                    counts[f] += 1
            return sum(c * c for c in counts.values())

        choices = {0: cost([*fills, size])}
        for level in {f for f in fills if f + size <= capacity and f < capacity}:
            k = max(i for i, f in enumerate(fills) if f == level)
            choices[level] = cost([*fills[:k], level + size, *fills[k + 1 :]])
        best = min(choices.values())
        level = max(h for h, c in choices.items() if c == best)
        if level == 0:
            fills.append(size)
        else:
            k = next(i for i in range(len(fills)) if fills[i] == level)
            fills[k] += size
        window.append(level)
    return fills


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=40), st.integers(2, 12))
def test_against_the_slow_way(sizes, capacity):
    sizes = [min(s, capacity) for s in sizes]
    window, fill = pk.sum_of_squares(np.array(sizes, np.int64), capacity)
    assert sorted(fill.tolist()) == sorted(slow(sizes, capacity))
    for w in range(len(fill)):
        assert sum(s for s, x in zip(sizes, window) if x == w) == fill[w] <= capacity


def check(packed, sizes, containers):
    """Every token of every document once in every container, whole documents whole, nothing too full."""
    by = defaultdict(list)
    windows = defaultdict(int)
    for r in packed:
        by[r["container_id"], r["doc_id"]].append((r["start"], r["n_tokens"]))
        windows[r["container_id"], r["block"], r["window"]] += r["n_tokens"]
    for cid, capacity in containers.items():
        assert all(n <= capacity for (c, _, _), n in windows.items() if c == cid)
        for doc, n in sizes.items():
            pieces = sorted(by[cid, doc])
            assert [s for s, _ in pieces] == list(range(0, n, capacity)) and sum(k for _, k in pieces) == n
            assert n > capacity or len(pieces) <= 1
    return windows


@pytest.mark.parametrize("block", [10, 100, 10_000])
def test_packing(spark, block):
    rng = np.random.default_rng(6)
    sizes = {k: int(n) for k, n in enumerate(rng.integers(1, 90, 600))} | {1000: 205, 1001: 64, 1002: 128}
    containers = {1: 64, 2: 200}
    df = spark.createDataFrame(list(sizes.items()), "doc_id bigint, n_tokens bigint")
    packed = pk.pack(df, spark.createDataFrame([*containers.items(), (3, None), (None, 5), (1, 64)], "container_id int, capacity_tokens int"), block)
    windows = check(packed.collect(), sizes, containers)
    used = {c: sum(n for (x, _, _), n in windows.items() if x == c) / sum(cap for (x, _, _), cap in ((w, containers[c]) for w in windows) if x == c) for c in containers}
    assert min(used.values()) > 0.85
    rates = {r["container_id"]: r for r in pk.fill_rates(packed).collect()}
    assert rates[2]["unused_share"] == pytest.approx(1 - used[2])


def test_sizes_and_edges(spark):
    docs = spark.createDataFrame([(1, "Hello world, it's 2024!", 0), (2, None, 0), (3, "", 0), (4, " ", 0), (1, "Hello world, it's 2024!", 0)], "doc_id bigint, text string, n_tokens int")
    encoder = pk._encoder(pk.TOKENIZER)
    got = sorted(map(tuple, pk.token_sizes(docs).collect()))
    assert got == [(1, len(encoder.encode_ordinary("Hello world, it's 2024!")))] * 2 + [(4, 1)]
    assert encoder.decode(encoder.encode_ordinary("Straße, naïve — ok")) == "Straße, naïve — ok"
    empty = spark.createDataFrame([], "container_id int, capacity_tokens int")
    assert pk.pack(pk.token_sizes(docs), empty).count() == 0
    assert pk.pack(pk.token_sizes(docs.limit(0)), spark.createDataFrame([(1, 8)], "container_id int, capacity_tokens int")).count() == 0
    assert pk.pack(pk.token_sizes(docs), spark.createDataFrame([(1, 8)], "container_id int, capacity_tokens int")).count() == 3 + (got[0][1] > 8) * 2


def test_every_container_is_packed(spark):
    containers = spark.range(1100).selectExpr("cast(id as int) container_id", "cast(id % 7 + 8 as int) capacity_tokens")
    sizes = spark.createDataFrame([(1, 5), (2, 9)], "doc_id bigint, n_tokens bigint")
    assert pk.pack(sizes, containers).select("container_id").distinct().count() == 1100
