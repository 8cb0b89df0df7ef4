"""Problem 3: values cut off by field limits or transfers.

Per source and measure (characters, bytes, tokens) the lengths are counted. A limit is a spike at the maximum: a length
that holds far more values than those below it and has next to nothing above it, most of them without an ending. A
value is judged truncated, by the first of these that holds:

* *at a limit*: it stands at a limit of its source, and it has no ending: its layout structure is left open, it stops
  between two blocks, or its visible text stops inside a sentence without terminal punctuation;
* *open structure*: its layout structure is left open;
* *fewer characters than tokens*: its token count says that the model wrote clearly more than what is stored, and it
  ends inside a sentence or between blocks, or no script would cost that many tokens. What a character costs in tokens
  is learnt from the whole values of the same script profile;
* *ends inside a word*: it stops inside a sentence with what is no word of the corpus but the beginning of one.

The last two leave alone a page whose last sentence runs on to the next page: its token count fits what is stored, and
its last word is whole. Values are read once: one pass describes them and counts the corpus's words; all else works on
lengths, histograms and words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.session import cut_lineage

#: A limit holds at least this many values and this many times the usual count of the lengths just below it.
MIN_SPIKE = 5
SPIKE_FACTOR = 4.0
#: Lengths this far from a limit still belong to it: a cut in the middle of a character misses it by that much.
SLACK = {"chars": 0, "bytes": 4, "tokens": 0}
#: Lengths below a limit whose usual count it is compared with.
NEIGHBOURS = 200
#: Part of the values at a limit that may lie above it, and part of them that must be without an ending.
ABOVE = 0.25
UNENDED = 0.6
#: Tokens beyond the expected count, as a share of it, that speak of lost text.
SURPLUS = 0.03
#: A word of the corpus occurs this often, and no more rarely than once in so many uses of the words that begin with it.
KNOWN = 3
KNOWN_SHARE = 0.001

# Elements that the model always closes.
_CONTAINERS = ("div", "ol", "ul", "table")
_LAST_CLOSED = frozenset(("div", "p", "table", "ul", "ol", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "math", "section"))
_NO_PROSE = frozenset(("code", "pre", "math", "chem"))
_TERMINAL = frozenset(".!?:;…。！？)]\"'”»’")
_LAYOUT = re.compile(r"<div[^<>]*data-(?:bbox|label)", re.I)
_FOOTER = re.compile(r"""<div[^<>]*data-label="Page-Footer"[^<>]*>""", re.I)
_END_TAG = re.compile(r"</([a-z0-9]+)>")
_TAG = re.compile(r"<[^<>]*>?")
_WORDS = re.compile(r"[^\W\d_]+(?:['’-]+[^\W\d_]+)*")
_LETTERS_ONLY = re.compile(r"[^\W\d_][\w'’-]*")
_CYRILLIC, _EXTENDED, _OTHER = (re.compile(f"[{block}]") for block in ("Ѐ-ӿ", "Ā-ſ", "Ͱ-Ͽ԰-῿⺀-퟿"))


def _body(raw: str) -> str:
    """``raw`` without the page footer that ends it."""
    at = raw.rfind("<div")
    if at >= 0 and _FOOTER.match(raw, at) and raw.rstrip().lower().endswith("</div>"):
        return raw[:at]
    return raw


def _last_text(raw: str) -> tuple[str, list[str]]:
    """Text that stands before the end tags at the end of a value, back to the tag before it, and those end tags."""
    closed: list[str] = []
    text = raw.rstrip()
    while text.endswith(">"):
        at = text.rfind("<")
        tag = _END_TAG.fullmatch(text, at) if at >= 0 else None
        if tag is None:
            break
        closed.append(tag[1])
        text = text[:at].rstrip()
    return text[text.rfind(">") + 1 :], closed


def _share(n: int, letters: int, width: int) -> int:
    """Share of letters in classes; none at all is a class of its own."""
    return 0 if n == 0 else min(n * 100 // letters // width + 1, 9)


def describe_text(raw: str) -> tuple[int, int, bool, bool, bool, bool, str, str]:
    """Characters, bytes, open, gap, terminal, midway, last word before the end tags and script profile of a non-blank value."""
    letters, size = len(raw), len(raw.encode("utf-8", "surrogatepass"))
    lower = raw.lower()
    _, closed = _last_text(lower)
    laid_out = "data-" in lower and _LAYOUT.search(raw) is not None
    unbalanced = any(lower.count(f"<{tag}") > lower.count(f"</{tag}>") for tag in _CONTAINERS)
    opened = laid_out and (not closed or closed[0] not in _LAST_CLOSED or unbalanced)
    gap = laid_out and raw[-1:].isspace() and "\n" in raw[len(raw.rstrip()) :]
    body = _body(raw)
    text, ends = _last_text(body.lower())
    visible = _TAG.sub(" ", text).strip()
    words = visible.split()
    last = words[-1] if words else ""
    midway = bool(ends) and len(words) >= 3 and _LETTERS_ONLY.fullmatch(last) is not None and not _NO_PROSE & set(ends) and not words[-3] == words[-2] == last
    profile = "0/0/0"
    if size != letters:
        profile = "/".join(str(_share(len(p.findall(raw)), letters, width)) for p, width in ((_CYRILLIC, 8), (_EXTENDED, 1), (_OTHER, 20)))
    # A text that is empty back to the last tag ends with what stands before that.
    shown = visible or _TAG.sub(" ", body).strip()
    return letters, size, opened, gap, shown[-1:] in _TERMINAL if shown else False, midway, last, profile


READ_SCHEMA = (
    "word string, n bigint, request_id bigint, source string, tokens bigint, chars bigint, bytes bigint, open boolean, gap boolean, "
    "terminal boolean, midway boolean, last_word string, profile string, hash bigint"
)
_CALL = ("request_id", "source", "tokens", "chars", "bytes", "open", "gap", "terminal", "midway", "last_word", "profile", "hash")


def _read(results: DataFrame) -> DataFrame:
    """One row per call with text and, beside them (``word`` not null), the words of all values with their counts.

    The last word of each value isn't counted. Counts are combined in every batch.
    """
    raw = F.col("raw")
    rows = results.where(F.length(F.trim(raw)) > 0).select(
        F.col("request_id").cast("long").alias("request_id"), F.coalesce("source", F.lit("")).alias("source"), F.col("token_count").cast("long").alias("tokens"), raw.alias("raw"), F.xxhash64(raw).alias("hash")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            described, words = [], Counter()
            for text in part["raw"]:
                made = describe_text(text)
                described.append(made)
                found = _WORDS.findall(_TAG.sub(" ", text).lower())
                words.update(found)
                if made[6] in words:
                    words[made[6]] -= 1  # the value may be cut inside it
            calls = pd.DataFrame(described, columns=["chars", "bytes", "open", "gap", "terminal", "midway", "last_word", "profile"])
            calls[["request_id", "source", "tokens", "hash"]] = part[["request_id", "source", "tokens", "hash"]].reset_index(drop=True)
            calls["word"], calls["n"] = None, None
            yield _typed(calls)
            seen = [(w, n) for w, n in words.items() if n > 0]
            yield _typed(pd.DataFrame({"word": [w for w, _ in seen], "n": [n for _, n in seen], **dict.fromkeys(_CALL)}))

    return rows.mapInPandas(run, READ_SCHEMA)


def _typed(df: pd.DataFrame) -> pd.DataFrame:
    kinds = {"bigint": "Int64", "boolean": "boolean", "string": object}
    fields = [f.split() for f in READ_SCHEMA.split(", ")]
    return df[[name for name, _ in fields]].astype({name: kinds[kind] for name, kind in fields})


def _calls(read: DataFrame) -> DataFrame:
    return read.where("word is null").select(*_CALL).dropDuplicates(["request_id", "source", "tokens", "hash"]).drop("hash")


def describe(results: DataFrame) -> DataFrame:
    """One row per call with non-empty ``raw``: lengths, ending and script profile; repeated rows count once."""
    return _calls(_read(results))


def limits(described: DataFrame) -> DataFrame:
    """Lengths that are a limit of their source: (source, measure, limit_value, n_at, n_open_at, usual, n_above)."""
    long = described.select(
        "source", (F.col("open") | ~F.col("terminal")).alias("unended"),
        F.explode(F.create_map(*[x for m in SLACK for x in (F.lit(m), F.col(m))])).alias("measure", "value"),
    ).where("value is not null")
    histogram = long.groupBy("source", "measure", "value").agg(F.count("*").alias("n"), F.sum(F.col("unended").cast("long")).alias("n_open"))
    # One window per source and measure; it has at most as many rows as there are distinct lengths.
    window = Window.partitionBy("source", "measure").orderBy("value")
    slack = F.element_at(F.create_map(*[x for m, k in SLACK.items() for x in (F.lit(m), F.lit(k))]), F.col("measure"))
    most = max(SLACK.values())

    def around(col: str, low: int, high: int) -> Column:
        return F.coalesce(F.sum(col).over(window.rangeBetween(low, high)), F.lit(0))

    def at(col: str) -> Column:
        return F.when(slack > 0, around(col, -most, most)).otherwise(F.col(col))

    above = F.when(slack > 0, around("n", most + 1, Window.unboundedFollowing)).otherwise(around("n", 1, Window.unboundedFollowing))
    spikes = histogram.withColumns({"n_at": at("n"), "n_open_at": at("n_open"), "usual": around("n", -NEIGHBOURS, -most - 1) / NEIGHBOURS, "n_above": above})
    return (
        spikes.where((F.col("n_at") >= MIN_SPIKE) & (F.col("n_at") >= SPIKE_FACTOR * (F.col("usual") + 1)))
        .where((F.col("n_open_at") >= UNENDED * F.col("n_at")) & (F.col("n_above") <= ABOVE * F.col("n_at")))
        .select("source", "measure", F.col("value").alias("limit_value"), "n_at", "n_open_at", "usual", "n_above")
    )


def _at_limit(measure: str, slack: int) -> Column:
    """Whether the length of a value stands at one of the limits of its source."""
    return F.coalesce(F.exists(F.col(f"{measure}_limits"), lambda limit: F.col(measure).between(limit - slack, limit + slack)), F.lit(False))


def broken_words(words: DataFrame, last_words: DataFrame) -> DataFrame:
    """Those of ``last_words`` (last_word) that are no word of the corpus but the beginning of one: a cut inside a word.

    ``words`` has the corpus's words with their counts (word, n). Words and beginnings meet on their first eight
    letters, or on fewer if the beginning is shorter.
    """
    asked = last_words.where("last_word <> ''").distinct()
    own = asked.join(words, F.col("last_word") == F.col("word"), "left").select("last_word", F.coalesce("n", F.lit(0)).alias("n"))
    known = words.where(F.col("n") >= KNOWN)
    keyed = known.select("word", F.col("n").alias("uses"), F.explode(F.transform(F.sequence(F.lit(1), F.least(F.length("word"), F.lit(8))), lambda k: F.left("word", k))).alias("key"))
    longer = (F.length("word") > F.length("last_word")) & F.startswith(F.col("word"), F.col("last_word"))
    met = own.withColumn("key", F.left("last_word", F.lit(8))).join(keyed, "key").where(longer)
    begun = met.groupBy("last_word", "n").agg(F.sum("uses").alias("uses"))
    return begun.where((F.col("n") < KNOWN) | (F.col("n") < KNOWN_SHARE * F.col("uses"))).select("last_word")


def truncation(results: DataFrame) -> DataFrame:
    """Verdict per call: request_id, source, reason (null if whole), truncated.

    Calls without text have no row. Null sources form a source of their own, null token counts take no part in the
    token test. Of repeated rows one is kept.
    """
    read = cut_lineage(_read(results))
    rows = _calls(read)
    words = read.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    # A source has a handful of limits, and there is one row per source.
    own = limits(rows).groupBy("source").agg(*[F.collect_set(F.when(F.col("measure") == m, F.col("limit_value"))).alias(f"{m}_limits") for m in SLACK])
    rows = rows.join(own, "source", "left")
    standing = F.lit(False)
    for measure, slack in SLACK.items():
        standing = standing | _at_limit(measure, slack)
    whole = ~F.col("open") & (F.col("chars") >= 200) & F.col("tokens").isNotNull()
    rate = F.col("tokens") / F.col("chars")
    cost = rows.where(whole).groupBy("profile").agg(F.percentile_approx(rate, 0.5, 2000).alias("cost"), F.percentile_approx(rate, 0.9, 2000).alias("high"), F.count("*").alias("n_profile"))
    dearest = read.where("word is null").where(whole).agg(F.percentile_approx(rate, 0.98, 2000)).first()[0]  # one value
    # There are at most 10 x 10 x 10 profiles.
    judged = rows.join(F.broadcast(cost), "profile", "left").withColumn("standing", standing)
    inside = ~F.col("open") & ~F.col("terminal") & F.col("midway")
    # A profile whose values cost very different amounts mixes languages: there the dearer of them is the measure.
    expected = F.when(F.coalesce("n_profile", F.lit(0)) < 20, F.lit(dearest)).when(F.col("high") > 1.04 * F.col("cost"), F.col("high")).otherwise(F.col("cost"))
    surplus = F.coalesce((F.col("tokens") - 3) > (1 + SURPLUS) * expected * F.col("chars"), F.lit(False)) & (F.col("chars") >= 80)
    reason = (
        F.when(F.col("standing") & (F.col("open") | F.col("gap") | inside), "at a limit").when(F.col("open"), "open structure")
        .when(F.coalesce(F.col("tokens") > 1.1 * F.lit(dearest) * F.col("chars"), F.lit(False)) & (F.col("chars") >= 80), "fewer characters than tokens")
        .when(surplus & (inside | F.col("gap")), "fewer characters than tokens")
    )
    judged = judged.withColumn("reason", reason).withColumn("doubt", F.col("reason").isNull() & inside & (F.col("last_word") != "")).select("request_id", "source", "reason", "doubt", "last_word")
    # Only values that end inside a sentence are held against the corpus's words.
    doubtful = judged.where("doubt")
    broken = broken_words(words, doubtful.select("last_word")).withColumn("broken", F.lit("ends inside a word"))
    settled = judged.where("not doubt").select("request_id", "source", "reason")
    found = settled.unionByName(doubtful.join(broken, "last_word", "left").select("request_id", "source", F.col("broken").alias("reason")))
    return found.withColumn("truncated", F.col("reason").isNotNull())


def truncation_rates(results: DataFrame) -> DataFrame:
    """Truncation rate of every source over its distinct calls, and the calls found by each rule.

    Columns: source, n_calls, n_truncated, rate, n_at_limit, n_open, n_surplus, n_broken.
    """
    rules = {"n_at_limit": "at a limit", "n_open": "open structure", "n_surplus": "fewer characters than tokens", "n_broken": "ends inside a word"}
    return truncation(results).groupBy("source").agg(
        F.count("*").alias("n_calls"), F.count_if("truncated").alias("n_truncated"), F.avg(F.col("truncated").cast("double")).alias("rate"),
        *[F.count_if(F.coalesce(F.col("reason") == text, F.lit(False))).alias(name) for name, text in rules.items()],
    )
