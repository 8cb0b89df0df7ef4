"""Problem 1: repetition inside a single text value.

Every value is measured on its visible words (tags, link targets and list numbers removed), by several rules:

* ``copied``: words covered by a passage of at least five words that has occurred before in the same value;
* ``looped``: words in a unit shorter than five words that is repeated back to back more than ten times, and
  characters of a single unbroken word that is such a loop itself;
* ``line_share`` and ``block_share``: characters of lines, and of paragraphs, that have occurred before;
* ``phrase_share``: words in further occurrences of the value's most repeated phrase of two to four words, which
  copies of five words miss where every fifth word varies.

In scripts written without spaces every character is a word, and a passage has ten of them.

The host stage then follows the rules-per-host pattern: failures of every rule are counted by host (the place that
stored the value, or the book it belongs to), the failure rates of every host are shrunk towards the overall ones by a
beta prior whose two parameters are fitted to all hosts, and the host's rates are joined back to its values. A value is
repetitive by its posterior: the odds that its share is 0.30 or more, given how exactly it can be measured, times how
much likelier failures are at its host than at all. Hosts move values near the threshold, and no others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.session import cut_lineage

PASSAGE_WORDS = 5
LOOP_REPEATS = 10
#: Characters of a passage in scripts without spaces.
PASSAGE_SIGNS = 10
FAIL_SHARE = 0.30
#: Share from which on lines, paragraphs and short phrases fail their rules.
RULES = {"failed_copies": "word_share", "failed_loops": "loop_share", "failed_lines": "line_share", "failed_blocks": "block_share", "failed_phrases": "phrase_share"}
#: How exactly a share can be measured, at least: shares of words and characters differ by such amounts.
TOLERANCE = 0.01
#: Hosts that hold this part of all values, at most 1 / HOT_PART of them, are sent to the values; others are joined.
HOT_PART = 1e-4
#: Unbroken words longer than this are searched for a loop inside the word.
LONG_WORD = 22

_TAG = re.compile(r"<[^<>]*>|\]\([^()\s]*\)")
_LIST_NUMBER = re.compile(r"(?m)^[ \t]*\d{1,4}[.)][ \t]+")
# Scripts written without spaces (Thai to Khmer, kana, Han).
_UNSPACED = "฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
_SIGN = re.compile(f"[{_UNSPACED}]")
_TOKEN = re.compile(r"\w+|(?<=\s)[^\w\s]+(?=\s)")
_SIGN_TOKEN = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+|(?<=\s)[^\w\s]+(?=\s)")
_INNER_LOOP = re.compile(r"(.{1,24}?)\1{10,}", re.S)

MEASURE_SCHEMA = "n_words bigint, n_chars bigint, word_share double, char_share double, loop_share double, line_share double, block_share double, phrase_share double"


def visible_words(text: str) -> list[str]:
    """Lower-cased words of the visible text; free-standing punctuation counts as a word of its own."""
    if "<" in text or "](" in text:
        text = _TAG.sub(" ", text)
    if "\n" in text or text[:1].isdigit():
        text = _LIST_NUMBER.sub("", text)
    text = f" {text.lower()} "
    return (_TOKEN if text.isascii() or not _SIGN.search(text) else _SIGN_TOKEN).findall(text)


def repeated_parts(text: str, split: str) -> float:
    """Share of the characters of the parts of a text, tags left out, that stand in parts that have occurred before."""
    parts = [x for p in _TAG.sub("\n", text).lower().split(split) if (x := p.strip())]
    if len(parts) < 2:
        return 0.0
    total = sum(map(len, parts))
    return 1 - sum(map(len, set(parts))) / total


def _first_occurrence(keys: np.ndarray) -> np.ndarray:
    """For every position, the first position that has the same key."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    starts = np.empty(len(keys), bool)
    starts[:1] = True
    np.not_equal(ranked[1:], ranked[:-1], out=starts[1:])
    first = np.empty(len(keys), np.int64)
    first[order] = order[np.maximum.accumulate(np.where(starts, np.arange(len(keys)), 0))]
    return first


def _cover(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Positions covered by the windows of ``width`` that begin at ``starts``."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + width, n), -1)
    return np.cumsum(change[:-1]) > 0


def measure_texts(texts: list[str | None]) -> pd.DataFrame:
    """Repetition of each text; null and empty texts have no words and shares of 0."""
    words: list[str] = []
    ends = np.empty(len(texts), np.int64)
    for k, text in enumerate(texts):
        if text:
            words += visible_words(text)
        ends[k] = len(words)
    n = len(words)
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
    ids = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    size = np.fromiter(map(len, words), np.int64, n)
    weight = np.where(size > LONG_WORD, 1, size)
    doc = np.repeat(np.arange(len(texts)), ends - begins)
    with np.errstate(over="ignore"):
        salted = ids * np.uint64(0x9E3779B97F4A7C15) ^ (ids >> np.uint64(29))
    sign = np.zeros(n, bool)
    if any(t and not t.isascii() and _SIGN.search(t) for t in texts):
        for k in np.flatnonzero(size == 1).tolist():
            sign[k] = _SIGN.match(words[k]) is not None

    def windows(width: int) -> tuple[np.ndarray, np.ndarray]:
        """Beginnings of the windows that lie within one text, and their hashes."""
        count = n - width + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            key = doc[:count].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            for k in range(width):
                key = key * np.uint64(0x5851F42D4C957F2D) + salted[k : count + k]
                key ^= key >> np.uint64(31)
        whole = np.flatnonzero(doc[:count] == doc[width - 1 :])
        return whole, key[whole]

    copied = np.zeros(n, bool)
    signs_before = np.concatenate([[0], np.cumsum(sign)])
    for width, signs in ((PASSAGE_WORDS, False), (PASSAGE_SIGNS, True)):
        if signs and not sign.any():
            continue
        whole, key = windows(width)
        held = (signs_before[whole + width] > signs_before[whole]) == signs
        whole, key = whole[held], key[held]
        first = whole[_first_occurrence(key)] if len(whole) else whole
        copied |= _cover(whole[whole - first >= width], width, n)
    # Further occurrences of the most repeated short phrase of each text.
    phrase = np.zeros(len(texts))
    for width in range(2, PASSAGE_WORDS):
        whole, key = windows(width)
        if not len(whole):
            continue
        order = np.argsort(key, kind="stable")
        begin = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
        times = np.diff(np.append(begin, len(order)))
        np.maximum.at(phrase, doc[whole[order[begin]]], (times - 1) * width)
    looped = np.zeros(n, bool)
    for unit in range(1, PASSAGE_WORDS):
        if n <= unit:
            break
        same = np.zeros(n, bool)
        same[unit:] = (ids[unit:] == ids[:-unit]) & (doc[unit:] == doc[:-unit])
        edge = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
        for a, b in zip(edge[::2], edge[1::2]):
            if (b - a) >= unit * LOOP_REPEATS:
                looped[a:b] = True
    # A long unbroken word may be a loop by itself; it then weighs what its letters would.
    inner = np.zeros(n, np.int64)
    for k in np.flatnonzero(size > LONG_WORD):
        word = words[k]
        if not word[0].isalnum() and size[k] < 200:
            continue  # leaders and rules
        weight[k] = size[k]
        inner[k] = sum(m.end() - m.start() - len(m[1]) for m in _INNER_LOOP.finditer(word))
    bad = copied | looped
    long_bad = np.where(bad, 0, inner)
    word_units = np.where(inner > 0, np.maximum(1, size // 6), 1)
    bad_units = np.where(bad, word_units, np.minimum(word_units, long_bad // 6))

    def total(x: np.ndarray) -> np.ndarray:
        acc = np.concatenate([[0], np.cumsum(x)])
        return acc[ends] - acc[begins]

    units, chars = total(word_units), total(weight)
    with np.errstate(divide="ignore", invalid="ignore"):
        return pd.DataFrame(
            {
                "n_words": ends - begins,
                "n_chars": chars,
                "word_share": np.nan_to_num(total(bad_units) / units),
                "char_share": np.nan_to_num((total(np.where(bad, weight, 0)) + total(long_bad)) / chars),
                "loop_share": np.nan_to_num((total(np.where(looped, weight, 0)) + total(long_bad)) / chars),
                "line_share": [repeated_parts(t, "\n") if t else 0.0 for t in texts],
                "block_share": [repeated_parts(t, "\n\n") if t else 0.0 for t in texts],
                "phrase_share": np.minimum(np.nan_to_num(phrase / (ends - begins)), 1.0),
            }
        )


def measure(df: DataFrame, text: str, keys: dict[str, object]) -> DataFrame:
    """Repetition of the column ``text``; ``keys`` names the columns to keep. The text itself isn't kept.

    Null, empty and blank texts come out with no words and a share of 0.
    """
    kept = df.select(*[F.expr(e).alias(k) if isinstance(e, str) else e.alias(k) for k, e in keys.items()], F.col(text).alias("_text"))
    names = list(keys)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name != "_text") + ", " + MEASURE_SCHEMA

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = measure_texts(part["_text"].tolist())
            for name in reversed(names):
                out.insert(0, name, part[name].to_numpy())
            yield out

    return kept.mapInPandas(run, schema)


def host_rates(measured: DataFrame) -> DataFrame:
    """Failure rates of every host of every field, shrunk by a beta prior fitted by moments to all hosts of the field.

    Columns: field, host, n_values, and for every rule of RULES and ``failed`` (any of them): n_<rule>, raw_<rule>,
    rate_<rule> and prior_<rule>. Null hosts share one group. Counts are added up before any shuffle, so a host that
    holds most rows is no hot key. A field whose hosts don't differ gets a strong prior.
    """
    rules = [*RULES, "failed"]
    flagged = measured.select("field", F.coalesce("host", F.lit("")).alias("host"), *[(F.col(c) >= FAIL_SHARE).alias(r) for r, c in RULES.items()])
    flagged = flagged.withColumn("failed", F.greatest(*[F.col(r) for r in RULES]))
    hosts = flagged.groupBy("field", "host").agg(F.count("*").alias("n_values"), *[F.count_if(r).alias(f"n_{r}") for r in rules])
    hosts = hosts.withColumns({f"raw_{r}": F.col(f"n_{r}") / F.col("n_values") for r in rules})
    moments = [F.avg("n_values").alias("mean_n")]
    for r in rules:
        moments += [(F.sum(f"n_{r}") / F.sum("n_values")).alias(f"prior_{r}"), F.avg(f"raw_{r}").alias(f"first_{r}"), F.avg(F.pow(f"raw_{r}", F.lit(2))).alias(f"second_{r}")]
    prior = hosts.groupBy("field").agg(*moments)  # one row per field

    def strength(r: str) -> Column:
        first = F.col(f"first_{r}")
        binomial = first * (1 - first)
        spread = F.greatest(F.col(f"second_{r}") - first * first - binomial / F.greatest(F.col("mean_n"), F.lit(1.0)), F.lit(1e-6))
        return F.greatest(binomial / spread - 1, F.lit(1.0))

    joined = hosts.join(F.broadcast(prior), "field")
    shrunk = {f"rate_{r}": (F.col(f"n_{r}") + F.col(f"prior_{r}") * strength(r)) / (F.col("n_values") + strength(r)) for r in rules}
    return joined.withColumns(shrunk).select("field", "host", "n_values", *[f"{kind}_{r}" for r in rules for kind in ("n", "raw", "rate", "prior")])


def _odds(rate: Column) -> Column:
    held = F.least(F.greatest(rate, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.ln(held / (1 - held))


def with_hosts(measured: DataFrame, rates: DataFrame) -> DataFrame:
    """``measured`` with the columns of ``rates``, joined on field and host.

    Hosts that hold at least HOT_PART of all values are sent to all tasks: there can't be more than 1 / HOT_PART of
    them. All other hosts are joined by key, and none of those is large.
    """
    total = rates.agg(F.coalesce(F.sum("n_values"), F.lit(0))).first()[0]
    hot, cold = rates.where(F.col("n_values") >= HOT_PART * total), rates.where(F.col("n_values") < HOT_PART * total)
    sent = measured.join(F.broadcast(hot), ["field", "host"], "left")
    columns = sent.columns
    rest = sent.where("n_values is null").select(*measured.columns).join(cold, ["field", "host"], "left")
    return sent.where("n_values is not null").unionByName(rest.select(*columns))


def repetition(values: DataFrame) -> DataFrame:
    """Repetition of each value with its own and its host's verdict.

    ``values``: the output of :func:`measure` with the columns field, record_key and host (null hosts share one
    group). Adds failed (the value's own verdict), host_rate, prior_rate, host_lift, host_suspect, probability and
    repetitive. Repeated input rows give repeated output rows.
    """
    measured = cut_lineage(values.withColumn("host", F.coalesce("host", F.lit(""))))
    rates = cut_lineage(host_rates(measured))
    joined = with_hosts(measured, rates.select("field", "host", "n_values", F.col("rate_failed").alias("host_rate"), F.col("prior_failed").alias("prior_rate"), *[f"{k}_{r}" for r in RULES for k in ("rate", "prior")]))
    # How much likelier the rules fail at this host than at all; the rule that tells most counts.
    lift = F.greatest(*[_odds(F.col(f"rate_{r}")) - _odds(F.col(f"prior_{r}")) for r in RULES])
    share = (F.col("word_share") + F.col("char_share")) / 2
    error = F.lit(TOLERANCE) + F.abs(F.col("word_share") - F.col("char_share")) / 2 + 1 / (F.col("n_words") + F.lit(100))
    odds = (share - FAIL_SHARE) / error + F.when(F.col("host_rate") > F.col("prior_rate"), lift).otherwise(_odds(F.col("host_rate")) - _odds(F.col("prior_rate"))) / 2
    judged = joined.withColumns({"failed": share >= FAIL_SHARE, "host_lift": lift, "host_suspect": F.col("host_rate") > F.col("prior_rate"), "probability": 1 / (1 + F.exp(-odds))})
    return judged.withColumn("repetitive", F.col("probability") >= 0.5).drop("n_values", *[f"{k}_{r}" for r in RULES for k in ("rate", "prior")])


def document_repetition(artifacts: DataFrame, results: DataFrame) -> DataFrame:
    """Repetition of every ``raw`` of the model calls and every ``markdown`` of the page artifacts."""
    raw = measure(results, "raw", {"field": F.lit("raw"), "record_key": F.col("request_id").cast("string"), "host": F.col("source")})
    page = F.concat(F.col("doc_id"), F.lit("/"), F.col("page_num").cast("string"))
    markdown = measure(artifacts, "markdown", {"field": F.lit("markdown"), "record_key": page, "host": F.col("doc_id")})
    return repetition(raw.unionByName(markdown))
