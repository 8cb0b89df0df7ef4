"""Problem 7: passages of held-out test items in the corpus, by greedy string tiling.

Passages and questions of the items are units; equal ones are one unit. Every five consecutive words of a unit are a
seed, hashed as Karp-Rabin does; five are few enough that no qualifying run can lack one (a run of 15 words or more in
which one word in eight is changed has five unchanged words in a row somewhere). Documents and units are joined on
seeds; where they share one, they are tiled: the longest common runs of unmarked words are marked first, then shorter
ones, down to two words. The runs come from one search of the shared pairs of words, or, where these are many, from
running Karp-Rabin.

How much of the unit the tiles cover decides. A unit is given away

* in a *stretch*: tiles of at least five words, in whatever order the document has them, cover all but one word in
  eight of 15 words or more in a row of the unit;
* in a *run*: the same with shorter tiles too, if they follow each other in both texts and no more than one word in
  eight is changed or added;
* in *pieces*: tiles of at least five words cover half of the unit and 15 words, or, of a unit shorter than 15 words,
  all but one word in eight.

Words are runs of letters or digits; in scripts written without spaces every character is one.

Test material up to ``BLOCK_CHARS`` characters is sent to the workers, and documents are scanned once. Larger material
stays a table: documents are scanned for seeds that a filter of fixed size lets through, those are joined with the
table of seeds, and only documents and units that share one are read again and tiled. Both ways give the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.session import cut_lineage

SEED_WORDS = 5
RUN_WORDS = 15
#: One word in so many may be changed or added.
CHANGED_IN = 8
MIN_TILE = 2
#: Share of a unit that tiles of SEED_WORDS or more cover, in any order, from which on it is given away in pieces.
COVERED = 0.5
#: Characters of test material up to which it is sent to the workers.
BLOCK_CHARS = 20_000_000
#: Words that a match must have for the first marking; longer ones are met at the same time.
FIRST_SEARCH = 20
#: Pairs of equal windows up to which all tiles are found from one search; more are searched for by width.
FEW_PAIRS = 1 << 16
#: Bits of the filter of seeds, as a power of two: 8 MB.
FILTER_BITS = 26
#: A document's units are compared with it in at most so many groups.
UNIT_GROUPS = 64

_SEPARATOR = re.compile(r"^[ \t]*\d*-{8,}[ \t]*$|<!--.*?-->", re.M | re.S)
_LINK = re.compile(r"\]\([^()\s]*\)|\]\]|\[\[(?:[^\[\]|\n]*\|)*|\{\{(?:[^{}|\n]*\|)*|\\[a-zA-Z]+\{|\[/?[a-z]+(?:=[^\]\n]*)?\]")
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_REFERENCE = re.compile(r"&(?:[a-zA-Z]{2,8}|#\d{2,6});")
_HYPHEN = re.compile(r"(?<=\w)[-­¬‐]\s*\n\s*(?=\w)|[­¬](?=\w)")
_HYPHEN_GAP = re.compile(r"(?<=[^\W\d_])[-­¬‐] (?=[^\W\d_])")
# Scripts written without spaces (Thai to Khmer, kana, Han).
UNSPACED = "฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{UNSPACED}]|[^\W_{UNSPACED}]+")
_SPACED_WORD = re.compile(r"[^\W_]+")
_SIGN = re.compile(f"[{UNSPACED}]")
#: What _SPACED_WORD takes for a word in lower-cased ASCII, and blanks for the rest.
_ASCII_WORDS = "".join(c if c.isalnum() else " " for c in map(chr, range(128)))


def words_of(text: str | None) -> list[str]:
    """Lower-cased words of a text; markup, page separators and hyphenation leave no trace."""
    if not text:
        return []
    if "--" in text:
        text = _SEPARATOR.sub("\n", text)
    if "-" in text or "¬" in text or "­" in text or "‐" in text:
        text = _HYPHEN_GAP.sub("", _HYPHEN.sub("", text))
    if "[" in text or "{" in text:
        text = _LINK.sub("", text)
    if "<" in text:
        text = _TAG.sub("", text)
    if "&" in text:
        text = _REFERENCE.sub(" ", text)
    text = text.lower()
    if text.isascii():
        return text.translate(_ASCII_WORDS).split()
    return (_WORD if _SIGN.search(text) else _SPACED_WORD).findall(text)


class Units:
    """Units of test material with their seeds; ``names`` says what stands for each of them in results."""

    def __init__(self, texts: list[str], names: list[object]) -> None:
        self.names = names
        words = [words_of(t) for t in texts]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for unit in words for w in unit}), 1)}
        self.ids = [np.array([self.vocabulary[w] for w in unit], np.int64) for unit in words]
        hashes, where = [], []
        for k, ids in enumerate(self.ids):
            found = seed_hashes(ids)
            hashes.append(found)
            where.append(np.stack([np.full(len(found), k), np.arange(len(found))]))
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        place = np.concatenate(where, axis=1) if where else np.zeros((2, 0), np.int64)
        order = np.argsort(flat, kind="stable")
        self.hashes, self.unit, self.position = flat[order], place[0][order], place[1][order]


def seed_hashes(ids: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Rolling hash of every SEED_WORDS consecutive word ids, or of those that begin ``at`` some places."""
    n = len(ids) - SEED_WORDS + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n if at is None else len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SEED_WORDS):
            out = out * np.uint64(0x9E3779B97F4A7C15) + (ids[k : k + n] if at is None else ids[at + k]).astype(np.uint64)
            out ^= out >> np.uint64(32)
    return out


_BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64)


def _powers_of(n: int) -> np.ndarray:
    """The first ``n`` powers of the base of the rolling hash."""
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, _BASE, np.uint64), dtype=np.uint64)])
    return _powers[:n]


class _Rolling:
    """Karp-Rabin hashes of all windows of a sequence, for any width."""

    def __init__(self, ids: np.ndarray) -> None:
        self.n = len(ids)
        with np.errstate(over="ignore"):
            mixed = ids.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)
            mixed ^= mixed >> np.uint64(32)
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * _powers_of(self.n), dtype=np.uint64)])

    def windows(self, width: int, used: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """Beginnings and hashes of the windows without a used word; ``longest`` puts two sequences on one scale."""
        at = np.arange(self.n - width + 1)
        if used.any():
            taken = np.concatenate([[0], np.cumsum(used)])
            at = at[taken[width:] == taken[: self.n - width + 1]]
        with np.errstate(over="ignore"):
            return at, (self.sums[at + width] - self.sums[at]) * _powers_of(longest)[longest - 1 - at]


def _extended(text: np.ndarray, unit: np.ndarray, used_text: np.ndarray, used_unit: np.ndarray, i: int, j: int, width: int) -> int:
    """Length of the run of equal, unused words that begins at (i, j); 0 if the window isn't equal after all."""
    n = min(len(text) - i, len(unit) - j)
    same = (text[i : i + n] == unit[j : j + n]) & ~used_text[i : i + n] & ~used_unit[j : j + n]
    length = n if same.all() else int(same.argmin())
    return length if length >= width else 0


def _common_runs(text: np.ndarray, unit: np.ndarray, width: int) -> list[tuple[int, int, int]] | None:
    """(-length, position in text, position in unit) of all longest common runs of ``width`` or more; None if there are too many."""
    n_text, n_unit = len(text) - width + 1, len(unit) - width + 1
    keys, own = np.zeros(n_text, np.uint64), np.zeros(n_unit, np.uint64)
    for k in range(width):
        keys = keys * np.uint64(_BASE) + text[k : k + n_text].view(np.uint64)
        own = own * np.uint64(_BASE) + unit[k : k + n_unit].view(np.uint64)
    order = own.argsort(kind="stable")
    own = own[order]
    first = own.searchsorted(keys)
    n = own.searchsorted(keys, "right") - first
    total = int(n.sum())
    if not total:
        return []
    if total > FEW_PAIRS:
        return None
    i = np.arange(n_text).repeat(n)
    j = order[np.arange(total) + (first - np.cumsum(n) + n).repeat(n)]
    same = text[i] == unit[j]
    for k in range(1, width):
        same &= text[i + k] == unit[j + k]
    # Pairs that follow each other on a diagonal are one run; diagonals are further apart than a text is long.
    place = np.sort((i[same] - j[same]) * (len(text) + len(unit)) + i[same])
    if not len(place):
        return []
    begin = np.flatnonzero(np.diff(place, prepend=place[0] - 2) != 1)
    length = np.diff(begin, append=len(place)) + width - 1
    shift, at = np.divmod(place[begin], len(text) + len(unit))
    return list(zip((-length).tolist(), at.tolist(), (at - shift).tolist()))


def _marked(runs: list[tuple[int, int, int]], n_text: int, n_unit: int, shortest: int) -> list[tuple[int, int, int]]:
    """Tiles made of all common runs: the longest are marked first, what earlier marks cut short comes again."""
    used_text, used_unit, found = bytearray(n_text), bytearray(n_unit), []
    heapify(runs)
    while runs:
        length, i, j = heappop(runs)
        length = -length
        in_text, in_unit = used_text[i : i + length], used_unit[j : j + length]
        if 1 not in in_text and 1 not in in_unit:
            used_text[i : i + length] = used_unit[j : j + length] = b"\1" * length
            found.append((i, j, length))
            continue
        at = 0
        for k in range(length + 1):
            if k == length or in_text[k] or in_unit[k]:
                if k - at >= shortest:
                    heappush(runs, (at - k, i + at, j + at))
                at = k + 1
    return sorted(found)


def tiles(text: list[int] | np.ndarray, unit: list[int] | np.ndarray, shortest: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (position in text, position in unit, length) of the longest non-overlapping common runs.

    Where few windows of the shortest width are equal, all common runs are known from one search. Else by running
    Karp-Rabin: all unmarked windows of a width are compared by rolling hashes and matches are extended; the longest are
    marked first. What earlier marks cut short comes again. Then the width is halved. Both ways give the same tiles.
    """
    text, unit = np.asarray(text, np.int64), np.asarray(unit, np.int64)
    if len(text) < shortest or len(unit) < shortest:
        return []
    runs = _common_runs(text, unit, shortest)
    return _tiles_by_width(text, unit, shortest) if runs is None else _marked(runs, len(text), len(unit), shortest)


def _tiles_by_width(text: np.ndarray, unit: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """Tiles by running Karp-Rabin."""
    roll_text, roll_unit, longest = _Rolling(text), _Rolling(unit), max(len(text), len(unit))
    used_text, used_unit = np.zeros(len(text), bool), np.zeros(len(unit), bool)
    found: list[tuple[int, int, int]] = []
    width = max(shortest, min(FIRST_SEARCH, len(text), len(unit)))
    while True:
        at, hashes = roll_text.windows(width, used_text, longest)
        own, keys = roll_unit.windows(width, used_unit, longest)
        order = np.argsort(keys, kind="stable")
        keys, own = keys[order], own[order]
        first, last = np.searchsorted(keys, hashes), np.searchsorted(keys, hashes, side="right")
        runs, seen = [], set()
        for k in np.flatnonzero(last > first).tolist():
            i = int(at[k])
            for j in own[first[k] : last[k]].tolist():
                if (i - 1, j - 1) in seen:
                    seen.add((i, j))
                    continue  # inside a longer run
                length = _extended(text, unit, used_text, used_unit, i, j, width)
                if length:
                    seen.add((i, j))
                    runs.append((length, i, j))
        runs.sort(key=lambda r: (-r[0], r[1], r[2]))
        while runs:
            rest, most = [], runs[0][0]
            for length, i, j in runs:
                free = ~(used_text[i : i + length] | used_unit[j : j + length])
                if length == most and free.all():
                    used_text[i : i + length] = used_unit[j : j + length] = True
                    found.append((i, j, length))
                    continue
                edge = np.flatnonzero(np.diff(np.concatenate([[0], free.view(np.int8), [0]])))
                rest += [(b - a, i + a, j + a) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= width]
            runs = sorted(rest, key=lambda r: (-r[0], r[1], r[2]))
        if width == shortest:
            return sorted(found)
        width = max(shortest, width // 2)


def longest_run(found: list[tuple[int, int, int]]) -> int:
    """Most words in a row of a unit that tiles make up with at most one word in CHANGED_IN changed or added."""
    best = 0
    for a in range(len(found)):
        changes = {a: 0}
        for b in range(a, len(found)):
            if b > a:
                i, j, _ = found[b]
                reach = [
                    changes[c] + max(i - found[c][0] - found[c][2], j - found[c][1] - found[c][2])
                    for c in changes
                    if c < b and found[c][1] + found[c][2] <= j and found[c][0] + found[c][2] <= i
                ]
                if not reach:
                    continue
                changes[b] = min(reach)
            span = found[b][1] + found[b][2] - found[a][1]
            if changes[b] * CHANGED_IN <= span:
                best = max(best, span)
    return best


def longest_stretch(covered: np.ndarray) -> int:
    """Most words in a row of a unit, beginning and ending covered, of which at most one in CHANGED_IN isn't covered."""
    at = np.flatnonzero(covered)
    if not len(at):
        return 0
    # From a to b, b - a + 1 words of which CHANGED_IN times the uncovered may be as many: the slack must not fall.
    slack = np.cumsum(np.where(covered, 1, 1 - CHANGED_IN))
    before, after = slack[at] - 1, slack[at]
    lowest = np.minimum.accumulate(before)
    # The earliest covered word from which the slack is no less: lowest never rises, so it is found by bisection.
    first = np.searchsorted(-lowest, -after)
    return int((at - at[first]).max()) + 1


def _windows(hits: list[tuple[int, int]], length: int, size: int) -> list[tuple[int, int]]:
    """Stretches of a document that a unit may take up, given the seeds they share."""
    pad = length // 4 + 4
    spans = sorted((max(0, at - pos - pad), min(size, at - pos + length + pad)) for at, pos in hits)
    merged = [list(spans[0])]
    for a, b in spans[1:]:
        if a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [tuple(x) for x in merged]


def compared(own: np.ndarray, target: np.ndarray, hits: list[tuple[int, int]]) -> tuple[int, int, float]:
    """Longest run, longest stretch and coverage of a unit in a document, given the seeds that they share.

    Places of the document that lie apart are tiled apart, and the best of them counts; coverage is of all.
    """
    run, stretch, covered = 0, 0, np.zeros(len(target), bool)
    for a, b in _windows(hits, len(target), len(own)):
        found = tiles(own[a:b], target)
        run = max(run, longest_run(found))
        here = np.zeros(len(target), bool)
        for _, j, k in found:
            if k >= SEED_WORDS:
                here[j : j + k] = True
        stretch = max(stretch, longest_stretch(here))
        covered |= here
    return run, stretch, float(covered.mean())


def _seed_run(hits: list[tuple[int, int]]) -> int:
    """Words of the longest unchanged run that seeds in a row make up; hits are in the order of the text."""
    best, last = 0, {}
    for at, position in hits:
        before, n = last.get(at - position, (-2, 0))
        n = n + 1 if before == at - 1 else 1
        last[at - position] = (at, n)
        best = max(best, n)
    return best + SEED_WORDS - 1


def scan(texts: Iterable[list[str]], units: Units, measured: bool = True) -> list[tuple[int, int, int, int, float]]:
    """(text, unit, longest run, longest stretch, coverage) of every text, given as its words, and unit that share seeds.

    Where only the verdict is wanted, not ``measured``, a unit whose seeds alone make up RUN_WORDS in a row isn't tiled:
    the run is as long as the seeds say, stretch and coverage are left 0.
    """
    get = units.vocabulary.get
    flat: list[int] = []
    ends = []
    for words in texts:
        flat += map(get, words, repeat(0))
        flat.append(0)
        ends.append(len(flat))
    if not len(units.hashes) or len(flat) < SEED_WORDS:
        return []
    ids = np.array(flat, np.int64)
    known = (ids > 0).astype(np.int8)
    full = np.flatnonzero(sum(known[k : len(ids) - SEED_WORDS + 1 + k] for k in range(SEED_WORDS)) == SEED_WORDS)
    hashes = seed_hashes(ids, full)
    at = np.searchsorted(units.hashes, hashes)
    at[at == len(units.hashes)] = 0
    hit = units.hashes[at] == hashes
    full, at, hashes = full[hit], at[hit], hashes[hit]
    owner = np.searchsorted(np.array(ends), full, side="right")
    pairs: dict[tuple[int, int], list[tuple[int, int]]] = {}
    last = np.searchsorted(units.hashes, hashes, side="right")
    for pos, a, b, doc in zip(full.tolist(), at.tolist(), last.tolist(), owner.tolist()):
        begin = ends[doc - 1] if doc else 0
        for k in range(a, b):
            pairs.setdefault((doc, int(units.unit[k])), []).append((pos - begin, int(units.position[k])))
    out = []
    for (doc, unit), hits in pairs.items():
        # A stretch of n words with c changes, c being n / 8 at most, leaves tiles with 7n / 8 - 4 (c + 1) seeds or more:
        # from 15 words on that is two at least, so what shares a single seed by chance needn't be tiled.
        if len(units.ids[unit]) >= RUN_WORDS and all(position == hits[0][1] for _, position in hits):
            continue
        if not measured and (run := _seed_run(hits)) >= RUN_WORDS:
            out.append((doc, unit, run, 0, 0.0))
            continue
        begin = ends[doc - 1] if doc else 0
        out.append((doc, unit, *compared(ids[begin : ends[doc] - 1], units.ids[unit], hits)))
    return out


def given_away(run: int, stretch: int, coverage: float, n_words: int) -> bool:
    """Whether a unit of ``n_words`` is leaked: by a run, by a covered stretch, or by pieces of any order."""
    if max(run, stretch) >= RUN_WORDS:
        return True
    if n_words < RUN_WORDS:
        return n_words >= SEED_WORDS and coverage * CHANGED_IN >= CHANGED_IN - 1
    return coverage >= COVERED and round(coverage * n_words) >= RUN_WORDS


def material(items: DataFrame, fields: tuple[str, ...] = ("passage", "question")) -> tuple[DataFrame, DataFrame, bool]:
    """Units (unit_id, unit), the items of each (unit_id, item_id), and whether the units are few enough to be sent out.

    Equal texts are one unit. ``unit_id`` is the text's hash of 128 bits.
    """
    longs = items.select("item_id", F.explode(F.array(*fields)).alias("unit")).where(F.length(F.trim("unit")) > 0).withColumn("unit_id", F.md5("unit"))
    units = longs.groupBy("unit_id").agg(F.first("unit").alias("unit"))
    total = units.agg(F.coalesce(F.sum(F.length("unit")), F.lit(0))).first()[0]
    return units, longs.select("unit_id", "item_id").distinct(), total <= BLOCK_CHARS


def sent(units: DataFrame) -> Units:
    """Units in memory, for material that :func:`material` found few enough."""
    rows = units.toPandas().sort_values("unit_id")
    return Units(rows["unit"].tolist(), rows["unit_id"].tolist())


UNIT_SCHEMA = "doc_id bigint, unit_id string, run_words int, stretch_words int, coverage double"


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in UNIT_SCHEMA.split(", ")])


def _sent_leaks(documents: DataFrame, units: DataFrame) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(sent(units))  # at most BLOCK_CHARS characters

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for part in batches:
            doc_ids = part["doc_id"].tolist()
            found = scan(map(words_of, part["text"]), known)
            yield _frame([(doc_ids[d], known.names[u], run, stretch, coverage) for d, u, run, stretch, coverage in found if given_away(run, stretch, coverage, len(known.ids[u]))])

    return documents.select("doc_id", "text").where("text is not null").mapInPandas(run, UNIT_SCHEMA)


def _word_hashes(words: list[str]) -> np.ndarray:
    """Word ids that need no vocabulary."""
    return pd.util.hash_array(np.array(words, object), categorize=True).view(np.int64) if words else np.zeros(0, np.int64)


def _joined_leaks(documents: DataFrame, units: DataFrame) -> DataFrame:
    """The same by joins, for material of any size."""
    spark = documents.sparkSession

    @F.pandas_udf("array<bigint>")
    def seeds(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(seed_hashes(_word_hashes(words_of(t)))).view(np.int64) for t in texts], dtype=object)

    seeded = cut_lineage(units.select("unit_id", F.explode(seeds("unit")).alias("seed")))
    mask = (1 << FILTER_BITS) - 1
    slot = F.col("seed").bitwiseAND(mask)
    # Only set bytes come to the driver, at most 2**(FILTER_BITS - 3).
    some = seeded.select(F.shiftright(slot, 3).alias("byte"), F.expr("shiftleft(1, cast(seed & 7 as int))").alias("bit")).groupBy("byte").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    table[some["byte"].to_numpy(np.int64)] = some["bits"].to_numpy(np.uint8)
    shared = spark.sparkContext.broadcast(table)

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            docs, found = [], []
            for doc, text in zip(part["doc_id"].tolist(), part["text"]):
                own = np.unique(seed_hashes(_word_hashes(words_of(text)))).view(np.int64)
                own = own[(shared.value[(own & mask) >> 3] >> (own & 7).astype(np.uint8)) & 1 > 0]
                docs.append(np.full(len(own), doc))
                found.append(own)
            yield pd.DataFrame({"doc_id": np.concatenate(docs), "seed": np.concatenate(found)}) if docs else pd.DataFrame({"doc_id": [], "seed": []})

    texts = documents.select("doc_id", "text").where("text is not null")
    pairs = texts.mapInPandas(hits, "doc_id bigint, seed bigint").join(seeded, "seed").select("doc_id", "unit_id").distinct()
    group = F.pmod(F.xxhash64("unit_id"), F.lit(UNIT_GROUPS))
    grouped = pairs.join(units, "unit_id").groupBy("doc_id", group.alias("unit_group")).agg(F.collect_list("unit_id").alias("names"), F.collect_list("unit").alias("units"))
    both = texts.join(grouped, "doc_id").select("doc_id", "text", "names", "units")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = []
            for doc, text, names, own in part.itertuples(index=False):
                known = Units(list(own), list(names))
                rows += [(doc, known.names[u], run, stretch, coverage) for _, u, run, stretch, coverage in scan([words_of(text)], known) if given_away(run, stretch, coverage, len(known.ids[u]))]
            yield _frame(rows)

    return both.mapInPandas(run, UNIT_SCHEMA)


def leaked_units(documents: DataFrame, units: DataFrame, few: bool) -> DataFrame:
    """Documents and the units they give away: doc_id, unit_id, run_words, stretch_words, coverage; repeated documents give repeated rows."""
    return _sent_leaks(documents, units) if few else _joined_leaks(documents, units)


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Documents and the items they give away: doc_id, item_id, run_words, stretch_words, coverage.

    One row per document and item, the greatest run, stretch and coverage of its passage and question, as far as they
    are given away. Null and empty texts match nothing; null passages and questions are no units; repeated rows count
    once; without items there are no rows.
    """
    units, owners, few = material(items)
    found = leaked_units(documents, units, few).groupBy("doc_id", "unit_id").agg(*[F.max(c).alias(c) for c in ("run_words", "stretch_words", "coverage")])
    return found.join(owners, "unit_id").groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("run_words", "stretch_words", "coverage")])
