"""Problem 5: language of every page and of every stretch in one language, by rank-order profiles.

A language's profile is the list of its most frequent letter n-grams (one to three letters, word ends marked). A text
is compared with each profile by the out-of-place distance: the n-grams of the text are ranked by frequency, and each
contributes how far its rank lies from its rank in the profile, or the profile's length if it isn't in it. Sentences
are compared one by one; the page's main language is that of the least total distance, and a sentence counts as
another language only if that language is nearer by a clear margin. Runs of sentences of one language are stretches.
Pages without running text are judged by the lines they have.

The languages are those that the labels name. Profiles are trained from the labelled pages in two passes: pages whose
label disagrees with the first pass's profiles take no part in the second, and a label most of whose pages disagree
names no language. Confidence is a logistic curve over how much nearer the language is than the next one, fitted to
labelled pages, and sentences of them, that took no part in training. Training reads at most ``TRAIN_PAGES`` pages per
language, chosen by a hash of their key.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.prose import is_full, paragraphs, sentences

PROFILE = 1500
TRAIN_PAGES = 2500
#: One labelled page in so many is held out of training, for the confidence.
HOLD_OUT = 5
#: Pages that must bear a label for it to name a language of its own, beyond those of NAMES.
MIN_PAGES = 20
#: By which part of the distance another language must be nearer than the page's main one.
MARGIN = 0.02
#: Bits of a letter: code points below 2048 as they are, others hashed.
_BITS = 11
_GRAM_BITS = 3 * _BITS

# Names and codes of languages, and labels that name none. A label that is no name here stands for itself.
NAMES: dict[str, tuple[str, ...]] = {
    "en": ("en", "eng", "english", "anglais", "englisch", "inglés", "ingles"),
    "de": ("de", "deu", "ger", "german", "deutsch", "allemand", "alemán"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais", "französisch", "francés"),
    "es": ("es", "spa", "esp", "spanish", "español", "espanol", "castilian", "spanisch", "espagnol"),
    "pt": ("pt", "por", "portuguese", "português", "portugues", "portugiesisch"),
    "it": ("it", "ita", "italian", "italiano", "italienisch", "italien"),
    "nl": ("nl", "nld", "dut", "dutch", "nederlands", "niederländisch", "flemish"),
    "pl": ("pl", "pol", "polish", "polski", "polnisch", "polonais"),
    "ru": ("ru", "rus", "russian", "русский", "russisch", "russe"),
}
NO_LANGUAGE = ("unknown", "und", "mul", "mis", "zxx", "unk", "none", "null", "nan", "other", "mixed", "undefined", "undetermined", "multiple", "language", "auto")
_NAME_OF = {name: lang for lang, names in NAMES.items() for name in names}


def label_language(label: Column) -> Column:
    """The language a label names, or null: spellings in any case, with or without region.

    A label of letters that isn't listed in NAMES names a language by itself, but for those of NO_LANGUAGE.
    """
    bare = F.regexp_replace(F.lower(F.trim(label)), r"\s*\(.*\)$|[-_ ][a-z0-9-]+$", "")
    whole = F.lower(F.trim(label))
    table = F.create_map(*[F.lit(x) for pair in _NAME_OF.items() for x in pair])
    own = F.when(bare.rlike(r"^\p{L}{2,}$") & ~bare.isin(*NO_LANGUAGE), bare)
    return F.coalesce(F.try_element_at(table, whole), F.try_element_at(table, bare), own)


_LETTERS = re.compile(r"[\W\d_]+")


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of all texts in one array (0 between texts, 1 for a word end) and the text each belongs to."""
    joined = "\x00" + "\x00".join(f" {x} " if (x := _LETTERS.sub(" ", t).strip()) else " " for t in texts) + "\x00"
    points = np.frombuffer(joined.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    high = points >= 1 << _BITS
    if high.any():
        points[high] = ((points[high] * 0x9E3779B1 >> 7) & ((1 << _BITS) - 1)) | 2
    gap = points == 0
    points[points == 32] = 1
    return points, np.cumsum(gap) - 1


def _grams(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams (n of 1 to 3) with their owners; none crosses two texts or is a word end alone."""
    out, own = [], []
    gram = codes
    valid = codes > 1
    out.append(gram[valid])
    own.append(owner[valid])
    inside = codes > 0
    for n in (2, 3):
        gram = (gram[:-1] << _BITS) | codes[n - 1 :]
        inside = inside[:-1] & (codes[n - 1 :] > 0)
        out.append(gram[inside])
        own.append(owner[: len(gram)][inside])
    return np.concatenate(out), np.concatenate(own)


def _ranked(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of every text with their ranks: (owner, gram, rank); n-grams of equal frequency share the mean rank."""
    codes, owner = _codes(texts)
    grams, own = _grams(codes, owner)
    key = np.sort((own << _GRAM_BITS) | grams)
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    count = np.diff(np.append(starts, len(key)))
    key = key[starts]
    own = key >> _GRAM_BITS
    order = np.argsort((own << 32) - count, kind="stable")
    key, own, count = key[order], own[order], count[order]
    position = np.arange(len(key))
    begin = np.zeros(len(key), np.int64)
    if len(key):
        first = np.concatenate([[True], own[1:] != own[:-1]])
        begin = np.maximum.accumulate(np.where(first, position, 0))
        tie = np.concatenate([[True], (own[1:] != own[:-1]) | (count[1:] != count[:-1])])
        at = np.flatnonzero(tie)
        size = np.diff(np.append(at, len(key)))
        mean = at + (size - 1) / 2
        position = np.repeat(mean, size)
    return own, key & ((1 << _GRAM_BITS) - 1), position - begin


class Profiles:
    """Ranks of n-grams by language, distances of texts from them, and the curve that turns distances into confidence."""

    def __init__(self, languages: list[str], grams: np.ndarray, ranks: np.ndarray, curve: tuple[float, float] = (60.0, 0.0)) -> None:
        """``ranks`` has a row for each of the sorted ``grams``, and one more for all others."""
        self.languages, self.grams, self.ranks, self.curve = languages, grams, ranks, curve

    @classmethod
    def of(cls, counts: pd.DataFrame) -> Profiles:
        """From the columns lang, gram and n, of which each language's most frequent are kept."""
        languages = sorted(counts["lang"].unique())
        tops = [counts[counts["lang"] == lang].sort_values(["n", "gram"], ascending=[False, True]).head(PROFILE)["gram"].to_numpy(np.int64) for lang in languages]
        grams = np.unique(np.concatenate(tops)) if tops else np.zeros(0, np.int64)
        ranks = np.full((len(grams) + 1, len(languages)), PROFILE, np.int16)
        for k, top in enumerate(tops):
            ranks[np.searchsorted(grams, top), k] = np.arange(len(top))
        return cls(languages, grams, ranks)

    def without(self, languages: set[str]) -> Profiles:
        """The profiles of the other languages."""
        kept = [k for k, lang in enumerate(self.languages) if lang not in languages]
        return Profiles([self.languages[k] for k in kept], self.grams, self.ranks[:, kept], self.curve)

    def confidence(self, gap: float) -> float:
        """Probability that a language is right that is nearer than the next by ``gap``."""
        a, b = self.curve
        return float(1 / (1 + np.exp(-np.clip(a * gap + b, -30, 30))))

    def distances(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Out-of-place distance of every text from every language, as a share of the greatest, and the number of n-grams."""
        out = np.ones((len(texts), len(self.languages)))
        size = np.zeros(len(texts))
        if not texts:
            return out, size
        own, gram, rank = _ranked(texts)
        if not len(own):
            return out, size
        starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        whose = own[starts]
        size[whose] = np.diff(np.append(starts, len(own)))
        rank = np.minimum(rank, PROFILE).astype(np.int16)
        place = np.searchsorted(self.grams, gram)
        place[place == len(self.grams)] = 0
        place = np.where(self.grams[place] == gram, place, len(self.grams)) if len(self.grams) else np.zeros(len(gram), np.int64)
        for k in range(len(self.languages)):
            there = self.ranks[place, k]
            apart = np.where(there == PROFILE, PROFILE, np.abs(there - rank))
            out[whose, k] = np.add.reduceat(apart, starts, dtype=np.int64) / (size[whose] * PROFILE)
        return out, size


def _page_sentences(markdown: str | None) -> list[str]:
    found: list[str] = []
    if markdown:
        for paragraph in paragraphs(markdown):
            found += [s for s in sentences(paragraph) if s.count(" ") >= 2 and len(set(s.lower().split())) > 2]
    return found


_NO_TEXT = re.compile(r"^(```+|~~~+)[^\n]*\n.*?(?:^\1[ \t]*$|\Z)|\$\$.+?\$\$|<[^<>]*>|\]\([^()\s]*\)", re.M | re.S)


def _page_lines(markdown: str | None) -> list[str]:
    """Lines of a page without running text that have letters: headings, lists, cells, short sentences."""
    if not markdown:
        return []
    return [line for line in _NO_TEXT.sub("\n", markdown).split("\n") if _LETTERS.sub("", line)]


def _labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Latest label of each page with the language it names."""
    return labels.groupBy("doc_id", "page_num").agg(F.max_by("lang_label", F.coalesce("labelled_at", F.lit("1970-01-01").cast("timestamp"))).alias("lang_label")).withColumn("label", label_language(F.col("lang_label")))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(place, np.concatenate([n for _, n in parts])).astype(np.int64)


def _count_grams(sample: DataFrame, known: Profiles | None) -> tuple[pd.DataFrame, dict[str, float]]:
    """Counts of n-grams by language (lang, gram, n), and which part of each language's pages ``known`` gives it.

    Counts are added up in each partition before the shuffle. With ``known``, only pages that it agrees on count.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        pages: Counter[tuple[str, bool]] = Counter()
        for part in batches:
            texts = [" ".join(_page_sentences(t)) for t in part["markdown"]]
            lang = part["label"].to_numpy()
            if known is not None:
                keep = np.array(known.languages, object)[known.distances(texts)[0].argmin(axis=1)] == lang
                pages.update((x, bool(k)) for x, k, t in zip(lang, keep, texts) if t)
                texts, lang = [t for t, k in zip(texts, keep) if k], lang[keep]
            for name in set(lang):
                grams, n = np.unique(_grams(*_codes([t for t, x in zip(texts, lang) if x == name]))[0], return_counts=True)
                own = total.setdefault(name, [])
                own.append((grams, n))
                if len(own) > 20:
                    total[name] = [_merged(own)]
        for name, own in total.items():
            grams, n = _merged(own)
            yield pd.DataFrame({"lang": name, "gram": grams, "n": n})
        # Numbers of pages go with them, as n-grams that can't be.
        yield pd.DataFrame([(name, -1 - agreed, n) for (name, agreed), n in pages.items()], columns=["lang", "gram", "n"])

    counted = sample.mapInPandas(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = F.row_number().over(Window.partitionBy("lang").orderBy((F.col("gram") >= 0).cast("int"), F.col("n").desc(), "gram"))
    # A bounded sample of pages has a bounded number of n-grams; PROFILE of each language come back.
    rows = counted.withColumn("rank", top).where(F.col("rank") <= PROFILE + 2).drop("rank").toPandas()
    marks = rows[rows["gram"] < 0].pivot_table(index="lang", columns="gram", values="n", aggfunc="sum", fill_value=0)
    agreed = {lang: float(row.get(-2, 0) / max(row.sum(), 1)) for lang, row in marks.iterrows()}
    return rows[rows["gram"] >= 0], agreed


def _fit_curve(held: DataFrame, known: Profiles) -> tuple[float, float]:
    """Slope and offset of the curve of confidence, from pages and sentences that took no part in training."""
    steps = 400

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((steps + 1, 2), np.int64)
        for part in batches:
            texts, label = [], []
            for text, lang in zip(part["markdown"], part["label"]):
                found = _page_sentences(text)
                texts += [" ".join(found), *found] if found else []
                label += [lang] * (len(found) + 1) if found else []
            dist, size = known.distances(texts)
            if not len(dist) or dist.shape[1] < 2:
                continue
            near = np.sort(dist, axis=1)
            gap = np.clip(np.rint((near[:, 1] - near[:, 0]) * steps), 0, steps).astype(int)
            right = np.array(known.languages, object)[dist.argmin(axis=1)] == np.array(label, object)
            np.add.at(table, (gap[size > 0], right[size > 0].astype(int)), 1)
        gap, right = np.nonzero(table)
        yield pd.DataFrame({"gap": gap, "agreed": right, "n": table[gap, right]})

    rows = held.mapInPandas(run, "gap int, agreed int, n bigint").groupBy("gap", "agreed").agg(F.sum("n").alias("n")).toPandas()
    return fitted_curve(rows["gap"].to_numpy() / steps, rows["agreed"].to_numpy(), rows["n"].to_numpy(float)) if len(rows) else (60.0, 0.0)


def fitted_curve(gap: np.ndarray, agreed: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Logistic curve through how often labels agree at each gap. Labels that are wrong even at the widest gaps are no doubt
    of the language: the curve is of agreement among the others."""
    order = np.argsort(gap)
    wide = gap >= np.sort(np.repeat(gap, np.maximum(n.astype(int), 0)))[int(n.sum()) // 2]
    wrong = min(0.4, (n[wide & (agreed == 0)].sum() + 0.5) / (n[wide].sum() + 10.0))
    at = np.array([60.0, 0.0])
    basis = np.stack([gap[order], np.ones(len(gap))])
    y, w, pull = agreed[order].astype(float), n[order], np.array([1e-4, 0.05])
    for _ in range(50):
        p = np.clip(1 / (1 + np.exp(-np.clip(at @ basis, -30, 30))), 1e-9, 1 - 1e-9)
        named, slope = (1 - wrong) * p, (1 - wrong) * p * (1 - p)
        g = basis @ (w * (y - named) * slope / (named * (1 - named))) - pull * (at - [60.0, 0.0])
        h = (basis * (w * slope**2 / (named * (1 - named)))) @ basis.T + np.diag(pull)
        at = at + np.clip(np.linalg.solve(h, g), [-20, -2], [20, 2])
    return max(float(at[0]), 1.0), float(at[1])


def train(pages: DataFrame, labels: DataFrame) -> Profiles:
    """Profiles of all languages that labels name. Raises ``ValueError`` if there is no usable label at all."""
    known = _labelled(pages, labels).where("label is not null")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).where(F.col("label").isin(*NAMES) | (F.col("n") >= MIN_PAGES)).collect()}  # one row per language
    if not sizes:
        raise ValueError("no page has a usable language label")
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, TRAIN_PAGES / n)))])
    drawn = known.where((F.pmod(F.xxhash64("doc_id", "page_num"), F.lit(1_000_000)) / 1_000_000) < F.try_element_at(share, F.col("label"))).select("doc_id", "page_num", "label")
    sample = pages.where(F.length(F.trim("markdown")) > 0).select("doc_id", "page_num", "markdown").join(F.broadcast(drawn), ["doc_id", "page_num"])  # at most TRAIN_PAGES per language
    sample = sample.select("markdown", "label", (F.pmod(F.xxhash64("doc_id", "page_num", F.lit(7)), F.lit(HOLD_OUT)) == 0).alias("held")).persist()
    training = sample.where("not held").select("markdown", "label")
    first = Profiles.of(_count_grams(training, None)[0])
    if not first.languages:
        raise ValueError("no labelled page has running text")
    counts, agreed = _count_grams(training, first)
    # What most of its own pages don't bear out is no language.
    none = {lang for lang in first.languages if agreed.get(lang, 0.0) < 0.5 and lang not in NAMES}
    second = Profiles.of(counts[~counts["lang"].isin(none)])
    second.curve = _fit_curve(sample.where("held").select("markdown", "label"), second)
    sample.unpersist()
    return second


STRETCH = "array<struct<lang: string, start: int, n_sentences: int, confidence: double, text: string>>"
LANGUAGES_SCHEMA = f"doc_id string, page_num int, running boolean, main_lang string, confidence double, languages array<string>, stretches {STRETCH}"


def _judge(dist: np.ndarray, size: np.ndarray, full: list[bool]) -> tuple[int, float, list[int], np.ndarray]:
    """Main language, by how much it is nearer than the next, languages with two full sentences or more, and the language of each sentence."""
    total = (dist * size[:, None]).sum(axis=0)
    own = dist.argmin(axis=1)
    # The main language holds most of the text: sentences vote with their length.
    votes = np.bincount(own, weights=size, minlength=dist.shape[1])
    main = int(np.lexsort((total, -votes))[0])
    own = np.where(dist[np.arange(len(own)), own] < dist[:, main] - MARGIN, own, main)
    counts = np.bincount(own[np.array(full, bool)], minlength=dist.shape[1])
    further = [k for k in np.flatnonzero(counts >= 2) if k != main]
    for k in set(own) - {main, *further}:
        own = np.where(own == k, main, own)
    mine = total / size.sum()
    rest = np.delete(mine, main)
    return main, float(rest.min() - mine[main]) if len(rest) else 1.0, [main, *further], own


def page_languages(pages: DataFrame, profiles: Profiles) -> DataFrame:
    """Languages of every page: running, main_lang, confidence, all languages, and the stretches in order.

    ``running`` says whether the page has running text; one that hasn't is judged by its lines. Pages without letters
    (null, empty, blank, numbers only) have no row; repeated rows give repeated rows.
    """
    packed = pages.sparkSession.sparkContext.broadcast(profiles)  # PROFILE n-grams a language

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = packed.value
        names = known.languages
        for part in batches:
            found, running = [], []
            for text in part["markdown"]:
                own = _page_sentences(text)
                running.append(bool(own))
                found.append(own or _page_lines(text))
            flat = [s for page in found for s in page]
            dist, size = known.distances(flat)
            rows, at = [], 0
            for doc, num, page, prose in zip(part["doc_id"], part["page_num"], found, running):
                d, n = dist[at : at + len(page)], size[at : at + len(page)]
                at += len(page)
                if not page or not n.sum():
                    continue
                main, gap, langs, own = _judge(d, n, [is_full(s) for s in page])
                stretches, begin = [], 0
                for k in range(1, len(page) + 1):
                    if k == len(page) or own[k] != own[begin]:
                        mean = (d[begin:k] * n[begin:k, None]).sum(axis=0) / max(n[begin:k].sum(), 1)
                        apart = np.delete(mean, own[begin]).min() - mean[own[begin]] if len(mean) > 1 else 1.0
                        stretches.append({"lang": names[own[begin]], "start": begin, "n_sentences": k - begin, "confidence": known.confidence(apart), "text": " ".join(page[begin:k])})
                        begin = k
                rows.append((doc, num, prose, names[main], known.confidence(gap), [names[k] for k in langs], stretches))
            yield pd.DataFrame(rows, columns=["doc_id", "page_num", "running", "main_lang", "confidence", "languages", "stretches"])

    return pages.select("doc_id", "page_num", "markdown").where(F.length(F.trim("markdown")) > 0).mapInPandas(run, LANGUAGES_SCHEMA)


def judged_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`page_languages` with profiles trained from ``labels``; without any usable label there are no rows."""
    try:
        return page_languages(pages, train(pages, labels))
    except ValueError:  # no language is known
        return pages.sparkSession.createDataFrame([], LANGUAGES_SCHEMA)


def relabelled(pages: DataFrame, labels: DataFrame, profiles: Profiles | None = None) -> DataFrame:
    """One row per language of each page with running text whose label is missing, unusable or wrong, or that holds several languages.

    Of several labels of a page the latest counts. Without any usable label in the table there are no rows.
    """
    made = page_languages(pages, profiles) if profiles is not None else judged_pages(pages, labels)
    judged = made.where("running").select("doc_id", "page_num", "main_lang", "languages")
    named = _labelled(pages, labels).select("doc_id", "page_num", "label")
    wrong = F.coalesce(F.col("label") != F.col("main_lang"), F.lit(True)) | (F.size("languages") > 1)
    return judged.join(named, ["doc_id", "page_num"], "left").where(wrong).select("doc_id", "page_num", F.explode("languages").alias("lang")).distinct()
