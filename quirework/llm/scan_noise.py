"""Problem 4: noise in text from scanned pages.

A noisy-channel repair in three passes over the corpus.

1. Words and word pairs of the running text of all pages are counted, in each partition first. Every word has a
   skeleton that is the same for all readings a scanner confuses (rn/m, cl/d, e/c, s/5 ...); words that share a
   skeleton with clearly more frequent words get all of those as candidates that have no candidates themselves.
   The probability of each confusion is estimated from all words and their most frequent candidates.
2. Every page names the pairs of words that its repair may have to weigh: those around words with candidates, the parts
   of words that may be joined up, words on both sides of a gap or a line end. Their exact counts are looked up.
3. Every paragraph with a doubtful word is decoded by Viterbi over the word itself and its candidates: the channel gives
   the confusion probability, the language model the pair counts. Paragraphs are decoded whole, not printed line by
   line, since a line end is no reason for the next word to be another. Spaced-out letters, joined-up words and words
   broken at line ends are rejoined or split where the result is a known word. Running heads and page numbers that
   stand in the body are taken out. What is left is joined to continuous paragraphs.

The most frequent words with their candidates, ``CACHE_WORDS`` in all, and up to ``CACHE_PAIRS`` pairs, go to the workers
as broadcasts of bounded size; what doesn't fit is joined to the pages that need it, with the same results. Frequencies
are compared with each other, never with fixed numbers that a larger corpus would reach by its size; small counts are
allowed the error they have.
"""

from __future__ import annotations

import difflib
import math
import re
import unicodedata
from collections import ChainMap, Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.llm.prose import paragraphs
from quirework.session import cut_lineage

#: Most words sent to the workers at once, every candidate beyond a word's second counted as one more; about 20 MB. Words
#: beyond them are joined to their pages.
CACHE_WORDS = 200_000
#: Most pairs with their counts sent to the workers at once; 16 MB.
CACHE_PAIRS = 1_000_000
#: A candidate is at least this many times as frequent as the word it may replace; words that mix letters and digits
#: are hardly ever right, so that less is enough for them.
RATIO = 40.0
MIXED_RATIO = 4.0
#: For words so rare that their count is mostly error: the ratio holds for the count less its error, and this one for the count.
RARE_RATIO = 12.0
#: A joined-up word is at most this part as frequent as its parts in a row, its count less its error taken, and half as
#: frequent in any case.
SPLIT_RATIO = 10.0
#: The same for the parts of joined-up words, which are sought among the words of the broadcast, and the whole of words with a gap.
PARTS_RATIO = 4.0
#: A candidate occurs at least this often; fewer uses prove nothing in a corpus of any size.
MIN_KNOWN = 5
#: Words with wrong letters from which on a page counts as misread.
MISREAD_WORDS = 3

# Readings that scanners confuse, each as the unit it is written as in a skeleton.
UNITS = {
    "m": "rn", "d": "cl", "u": "ii", "w": "vv", "e": "c", "f": "t", "5": "s", "1": "l", "i": "l", "|": "l", "0": "o", "q": "g", "9": "g", "6": "b",
    "h": "b", "8": "b", "н": "и", "п": "и", "о": "o", "е": "c", "з": "3",
}
_UNIT_TABLE = str.maketrans({k: v.replace("i", "l") for k, v in UNITS.items()})

_ACCENTS = ("áàâäãåéèêëíìîïóòôöõúùûüçñąćęłńóśźż", "aaaaaaeeeeiiiiooooouuuucnacelnoszz")

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_SPACED = re.compile(r"(?<![^\W_])[^\W\d_](?: [^\W\d_]){2,}(?![^\W_])")
_SOFT_BREAK = re.compile(r"([^\W\d_]+)[-­¬‐]\s+([^\W\d_]+)")
_LINE_END = re.compile(r"[-­¬‐][ \t]*(?:\n|<br ?/?>)\s*([^\W_]+)")
_LEFT = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*$")

# How running heads and page numbers are printed; N is the page's number.
_RUNNING_FORMS = (
    r"\W{0,3}N\W{0,3}", r"(?:page|p\.?|seite|s\.|pág\.|pagina|página|стр\.)\s*N(?:\s*(?:of|de|von|di|van|из|/)\s*\d+)?", r"N {2,}\S.{0,80}", r"\S.{0,80} {2,}N",
    r".{3,80}\s\|\s(?:recto|verso)(?:\s+N)?", r"N\s*[|·•–—]\s*\S.{0,80}", r"\S.{0,80}\s*[|·•–—]\s*N",
)
_RUNNING = re.compile("|".join(f"(?:{form})" for form in _RUNNING_FORMS), re.I)
_DIGIT_READINGS = str.maketrans("OolISsBgq", "001155899")
_BLOCK = re.compile(r"<div\b([^<>]*)>(.*?)</div>\s*(?=<div\b[^<>]*data-|\Z)", re.S)
_LABEL = re.compile(r'data-label="([^"]*)"')
_CLOSED_END = re.compile(r"[.!?:;…][\"'»”’)]*$")
_TAG = re.compile(r"<[^<>]*>")


def skeleton(word: str) -> str:
    """What all readings of a word that a scanner confuses have in common."""
    word = word.lower()
    if not word.isascii():
        word = "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))
    return word.translate(_UNIT_TABLE)


def word_keys(words: list[str]) -> np.ndarray:
    """Hashes of words, of 64 bits."""
    return pd.util.hash_array(np.array(words, object), categorize=False) if words else np.zeros(0, np.uint64)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of pairs of words, of 64 bits, as the numbers that tables hold."""
    with np.errstate(over="ignore"):
        mixed = left * np.uint64(0x9E3779B97F4A7C15) + right
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return mixed.view(np.int64)


def _running_words(markdown: str | None) -> list[list[str]]:
    """Words of each paragraph, lower-cased, without those that may be broken at a line end."""
    if not markdown:
        return []
    return [[w.lower() for w in _WORD.findall(_SOFT_BREAK.sub(" ", p) if "-" in p or "¬" in p or "­" in p or "‐" in p else p)] for p in paragraphs(markdown)]


def _word_counts(words: Counter[str]) -> pd.DataFrame:
    del words[""]
    n = len(words)
    return pd.DataFrame({"word": np.array([*words, None], object)[:n], "pair": pd.array([None] * n, "Int64"), "n": np.fromiter(words.values(), np.int64, n)})


def count_words(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts of the words (word, n) and of the pairs of words in a row (pair, n) of all running text.

    Pairs are named by their hash; the beginning and end of a paragraph is the empty word.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter[str] = Counter()
        keys: dict[str, int] = {}
        for part in batches:
            flat: list[str] = [""]
            for text in part["markdown"]:
                for paragraph in _running_words(text):
                    flat += paragraph
                    flat.append("")
            words.update(flat)
            new = list(set(flat) - keys.keys())
            keys.update(zip(new, word_keys(new).tolist()))
            if len(flat) > 1:
                ids = np.array([keys[w] for w in flat], np.uint64)
                pairs, n = np.unique(pair_keys(ids[:-1], ids[1:]), return_counts=True)
                yield pd.DataFrame({"word": np.full(len(pairs), None, object), "pair": pd.array(pairs, "Int64"), "n": n})
            if len(keys) > 500_000:
                keys.clear()
            if len(words) > 500_000:
                yield _word_counts(words)
                words.clear()
        yield _word_counts(words)

    counted = cut_lineage(pages.select("markdown").mapInPandas(run, "word string, pair bigint, n bigint").groupBy("word", "pair").agg(F.sum("n").alias("n")))
    return counted.where("word is not null").select("word", "n"), counted.where("word is null").select("pair", "n")


def _fits(word: Column, offer: Column) -> Column:
    """Whether ``offer`` is clearly more frequent than ``word``."""
    # A different accent makes another word, but for the i, whose dot is taken for one.
    another = (offer["bare"] != word["bare"]) | (offer["dotless"] == word["dotless"])
    return (offer["n"] >= word["least"]) & (offer["word"] != word["word"]) & another


def candidates(words: DataFrame) -> DataFrame:
    """Words with all their candidates, the most frequent first: (word, n, c1, n1, c2, n2, more).

    c1 and c2 are null where there are none; ``more`` holds the third and all further ones. A word with candidates is
    no candidate: decoding takes it for a word never seen, so that it never wins over the word as it stands.
    """

    @F.pandas_udf("string")
    def skeletons(column: pd.Series) -> pd.Series:
        return column.map(skeleton)

    mixed = F.col("word").rlike(r"\p{L}\d|\d\p{L}") & ~F.col("word").rlike(r"^\d+(th|st|nd|rd|er|e|s|h|km|kg|g|cm|mm|m)$")
    certain = F.greatest(RARE_RATIO * F.col("n"), RATIO * (F.col("n") - F.sqrt("n")))
    changeable = (F.length("word") > 1) & ~F.col("word").rlike(r"^\d+$")
    least = F.when(~changeable, F.lit(math.inf)).when(mixed, MIXED_RATIO * F.col("n")).otherwise(certain)
    form = F.struct("n", "word", F.translate("word", *_ACCENTS).alias("bare"), F.translate("word", "íìï", "iii").alias("dotless"), least.alias("least"))
    formed = words.select("word", "n", skeletons("word").alias("skeleton"), form.alias("s"))
    usable = formed.where((F.col("n") >= MIN_KNOWN) & ~F.col("word").rlike(r"\d"))
    # The most frequent word has no candidates, so that most others are known to have one without a look at the rest.
    best = usable.groupBy("skeleton").agg(F.max("s").alias("best"))
    rest = usable.join(best, "skeleton").where(~_fits(F.col("s"), F.col("best")))
    ranked = rest.groupBy("skeleton").agg(F.sort_array(F.collect_list("s"), asc=False).alias("ranked"))
    sound = F.aggregate("ranked", F.slice("ranked", 1, 0), lambda found, s: F.when(F.exists(found, lambda offer: _fits(s, offer)), found).otherwise(F.concat(found, F.array(s))))
    joined = formed.join(ranked.select("skeleton", sound.alias("sound")), "skeleton", "left")
    joined = joined.withColumn("offers", F.transform(F.filter("sound", lambda offer: _fits(F.col("s"), offer)), lambda o: F.struct(o["word"].alias("word"), o["n"].alias("n"))))
    first, second = F.get("offers", F.lit(0)), F.get("offers", F.lit(1))
    more = F.coalesce(F.filter("offers", lambda _, k: k >= 2), F.array().cast(_OFFERS))
    return joined.select("word", "n", first["word"].alias("c1"), first["n"].alias("n1"), second["word"].alias("c2"), second["n"].alias("n2"), more.alias("more"))


def confusions(word: str, truth: str) -> list[tuple[str, str]]:
    """Changes that turn ``truth`` into ``word``."""
    found = difflib.SequenceMatcher(None, truth, word, False).get_opcodes()
    return [(truth[a:b], word[c:d]) for kind, a, b, c, d in found if kind != "equal"]


def channel(lexicon: DataFrame, total: int) -> dict[tuple[str, str], float]:
    """Log probability of each confusion, from all words and their first candidates.

    Confusions are added up in every partition first; what is collected is one row per kind of confusion.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[tuple[str, str]] = Counter()
        for part in batches:
            for word, truth, n in part[["word", "c1", "n"]].itertuples(index=False):
                for change in confusions(word, truth):
                    seen[change] += n
        yield pd.DataFrame([(truth, read, n) for (truth, read), n in seen.items()], columns=["truth", "read", "n"])

    counted = lexicon.where("c1 is not null").select("word", "c1", "n").mapInPandas(run, "truth string, read string, n bigint")
    summed = counted.groupBy("truth", "read").agg(F.sum("n").alias("n")).toPandas()
    return {(truth, read): math.log((n + 1) / (total + 1000)) for truth, read, n in summed.itertuples(index=False)}


class Pairs:
    """Counts of pairs of words, by the hash of the pair: sorted arrays, and ``more`` of a single page."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, more: Mapping[int, int] | None = None) -> None:
        self.keys, self.counts, self.more = keys, counts, more or {}
        self._words: dict[str, int] = {}

    @classmethod
    def of(cls, counts: Mapping[tuple[str, str], int]) -> Pairs:
        keys = pair_keys(word_keys([a for a, _ in counts]), word_keys([b for _, b in counts]))
        order = np.argsort(keys)
        return cls(keys[order], np.fromiter(counts.values(), np.int64, len(counts))[order])

    def key(self, a: str, b: str) -> int:
        if len(self._words) > 500_000:
            self._words.clear()
        for w in (a, b):
            if w not in self._words:
                self._words[w] = int(word_keys([w])[0])
        return int(pair_keys(np.array([self._words[a]], np.uint64), np.array([self._words[b]], np.uint64))[0])

    def count(self, a: str, b: str) -> int:
        key = self.key(a, b)
        if key in self.more:
            return self.more[key]
        at = int(np.searchsorted(self.keys, key))
        return int(self.counts[at]) if at < len(self.keys) and self.keys[at] == key else 0


class Repairer:
    """Repairs texts with a lexicon, pair counts and a channel."""

    def __init__(self, lexicon: Mapping[str, tuple], pairs: Pairs, total: int, noise: dict[tuple[str, str], float], doubtful: frozenset[str] | None = None) -> None:
        self.lexicon, self.pairs, self.total, self.noise = lexicon, pairs, max(total, 1), noise
        self.rare = math.log(1 / (self.total + 1000))
        self._parts: dict[str, list[tuple[str, str]]] = {}
        # Words with candidates: those of the base, and of the page's own words.
        own = lexicon.maps[0] if isinstance(lexicon, ChainMap) and doubtful is not None else lexicon
        found = frozenset(w for w, entry in own.items() if entry[1])
        self.doubtful = found if doubtful is None else doubtful | found if found else doubtful

    def count(self, word: str) -> int:
        found = self.lexicon.get(word)
        return found[0] if found else 0

    def pair(self, a: str, b: str) -> int:
        return self.pairs.count(a, b)

    def _doubtful(self, word: str) -> bool:
        found = self.lexicon.get(word)
        return found is None or bool(found[1])

    def _transition(self, a: str, b: str) -> float:
        """Log probability of ``b`` after ``a``. A word with candidates, taken as it stands, is a word never seen."""
        if self._doubtful(b) and b:
            return math.log(0.05 / self.total)
        if self._doubtful(a) and a:
            return math.log(0.1 * (self.count(b) + 0.5) / self.total)
        return math.log(0.9 * self.pair(a, b) / (self.count(a) + 1) + 0.1 * (self.count(b) + 0.5) / self.total)

    def _emission(self, word: str, truth: str) -> float:
        if word == truth:
            return 0.0
        return sum(self.noise.get(change, self.rare) for change in confusions(word, truth))

    def options(self, word: str) -> list[str]:
        found = self.lexicon.get(word)
        if not found:
            return [word]
        return [word, *(c for c in found[1:] if c)]

    def decode(self, words: list[str]) -> list[str]:
        """Most likely words behind ``words``, by Viterbi."""
        states = [self.options(w) for w in words]
        if all(len(s) == 1 for s in states):
            return words
        score, back = {"": 0.0}, []
        for word, options in zip(words, states):
            now, come = {}, {}
            for option in options:
                emit = self._emission(word, option) if len(options) > 1 else 0.0
                prev = max(score, key=lambda p: score[p] + (self._transition(p, option) if len(options) > 1 or len(score) > 1 else 0.0))
                now[option] = score[prev] + (self._transition(prev, option) if len(options) > 1 or len(score) > 1 else 0.0) + emit
                come[option] = prev
            back.append(come)
            score = now
        last = max(score, key=score.get)
        out = []
        for come in reversed(back):
            out.append(last)
            last = come[last]
        return out[::-1]

    def parts(self, word: str) -> list[tuple[str, str]]:
        """The pairs of frequent words that a rarer word could be made of."""
        found = self._parts.get(word)
        if found is None:
            found = []
            if len(word) >= 5 and word.isalpha():
                least = PARTS_RATIO * max(self.count(word), MIN_KNOWN)
                found = [(word[:k], word[k:]) for k in range(1, len(word)) if self.count(word[:k]) >= least and self.count(word[k:]) >= least]
            if len(self._parts) > 500_000:
                self._parts.clear()
            self._parts[word] = found
        return found

    def split_joined(self, word: str) -> tuple[str, str] | None:
        """The two frequent words that a rare word is made of, if they often follow each other."""
        parts = self.parts(word)
        if not parts:
            return None
        n = self.count(word)
        least = max(2.0, 2.0 * n, SPLIT_RATIO * (n - 2 * math.sqrt(n)))
        together, best = max((self.pair(a, b), (a, b)) for a, b in parts)
        return best if together >= least else None

    def one_word(self, a: str, b: str) -> bool:
        """Whether ``a`` and ``b`` together are a word so frequent that a gap between them may stand inside it."""
        whole = self.count(a + b)
        return whole >= MIN_KNOWN and whole >= PARTS_RATIO * min(self.count(a), self.count(b))

    def is_word(self, word: str) -> bool:
        found = self.lexicon.get(word)
        return bool(found) and (found[0] >= MIN_KNOWN or bool(found[1]))

    def suspects(self, words: list[str]) -> bool:
        """Whether any word may have to be changed: most paragraphs are done with that."""
        if not self.doubtful.isdisjoint(words):
            return True
        known, lexicon = self._parts, self.lexicon
        for word in words:
            if len(word) >= 5:
                parts = known.get(word)
                if parts or (parts is None and self.parts(word)):
                    return True
        return any(a + b in lexicon and self.one_word(a, b) for a, b in zip(words, words[1:]))

    def _close_up(self, text: str) -> tuple[str, int]:
        """Text without spaces between the letters of words, and the number of words closed up."""
        wrong = 0

        def close_up(m: re.Match[str]) -> str:
            nonlocal wrong
            letters = m[0].split(" ")
            for a, b in ((0, len(letters)), (1, len(letters)), (0, len(letters) - 1)):
                word = "".join(letters[a:b])
                if len(word) > 2 and self.is_word(word.lower()):
                    wrong += 1
                    return " ".join([*letters[:a], word, *letters[b:]])
            word = "".join(letters)
            cuts = [k for k in range(1, len(word)) if self.is_word(word[:k].lower()) and self.is_word(word[k:].lower())]
            if not cuts:
                return m[0]
            wrong += 2
            cut = max(cuts, key=lambda k: (min(self.count(word[:k].lower()), self.count(word[k:].lower())), min(k, len(word) - k)))
            return word[:cut] + " " + word[cut:]

        return _SPACED.sub(close_up, text), wrong

    def paragraph(self, text: str) -> tuple[str, int]:
        """Repaired paragraph and the number of words that had wrong, joined-up or spaced-out letters."""
        joined, wrong = self._close_up(_SOFT_BREAK.sub(self._rejoin, text) if re.search("[-­¬‐] ", text) else text)
        words = [w.lower() for w in _WORD.findall(joined)]
        if not self.suspects(words):
            return joined, wrong
        tokens = list(_WORD.finditer(joined))
        fixed: list[str | None] = list(self.decode(words))
        if words and not _CLOSED_END.search(joined):
            fixed[-1] = words[-1]  # the page may end inside it
        for k, word in enumerate(words):
            if fixed[k] is None:
                continue  # the end of the word before
            if fixed[k] != word:
                wrong += 1
                continue
            if k + 1 < len(words) or _CLOSED_END.search(joined):
                parts = self.split_joined(word)
                if parts:
                    fixed[k] = " ".join(parts)
                    wrong += 1
                elif k + 1 < len(words) and fixed[k + 1] == words[k + 1] and word + words[k + 1] in self.lexicon and self.one_word(word, words[k + 1]) and joined[tokens[k].end() : tokens[k + 1].start()] == " ":
                    # A gap inside a word: neither part is a usual word, together they are one.
                    if self.pair(word, words[k + 1]) * PARTS_RATIO <= self.count(word + words[k + 1]):
                        fixed[k], fixed[k + 1] = word + words[k + 1], None
                        wrong += 1
        out, at = [], 0
        for m, word, new in zip(tokens, words, fixed):
            gap = joined[at : m.start()]
            at = m.end()
            if new is None:
                continue
            out.append(gap)
            out.append(m[0] if new == word else _like(m[0], new))
        out.append(joined[at:])
        return "".join(out), wrong

    def asks(self, raw: str | None, markdown: str | None) -> set[int]:
        """Hashes of the pairs of words whose counts repairing a page may take into account."""
        pairs: set[tuple[str, str]] = set()
        for left, right in line_breaks(raw):
            pairs.add((left.lower().rsplit("-", 1)[-1], right.lower()))
        for paragraph in paragraphs(markdown) if markdown else ():
            texts = [paragraph]
            if _SOFT_BREAK.search(paragraph):
                pairs.update((m[1].lower().rsplit("-", 1)[-1], m[2].lower()) for m in _SOFT_BREAK.finditer(paragraph))
                texts.append(_SOFT_BREAK.sub(r"\1\2", paragraph))
            if _SPACED.search(paragraph):
                texts += [self._close_up(t)[0] for t in texts]
            for text in texts:
                words = [w.lower() for w in _WORD.findall(text)]
                if not self.suspects(words):
                    continue
                if not self.doubtful.isdisjoint(words):
                    states = [self.options(w) for w in words]
                    for before, options in zip([[""], *states], states):
                        if len(options) > 1 or len(before) > 1:
                            pairs.update((a, b) for a in before if not a or not self._doubtful(a) for b in options if not self._doubtful(b))
                for a, b in zip(words, [*words[1:], ""]):
                    if len(a) >= 5:
                        pairs.update(self.parts(a))
                    if b and a + b in self.lexicon and self.one_word(a, b):
                        pairs.add((a, b))
        return {self.pairs.key(a, b) for a, b in pairs}

    def _rejoin(self, m: re.Match[str]) -> str:
        return m[1] + m[2] if self.broken(m[1], m[2]) else m[0]

    def broken(self, left: str, right: str) -> bool:
        """Whether ``left-`` and ``right`` are one word broken at a line end, rather than a compound or a code."""
        a, b, whole = left.lower().rsplit("-", 1)[-1], right.lower(), (left + right).lower()
        if any(c.isdigit() for c in a + b) or not b:
            return False
        together = self.count(a + b) or self.count(whole)
        if together >= MIN_KNOWN or self.is_word(a + b):
            apart = self.pair(a, b)
            return together >= apart or min(self.count(a), self.count(b)) < MIN_KNOWN
        known_a, known_b = self.count(a) >= MIN_KNOWN, self.count(b) >= MIN_KNOWN
        return b[0].islower() and right[:1].islower() and not (known_a and known_b)


def _like(old: str, new: str) -> str:
    """``new`` in the case of ``old``."""
    if old[:1].isupper():
        return new.upper() if len(old) > 1 and old.isupper() else new[:1].upper() + new[1:]
    return new


def is_running_line(line: str, page_num: int | None) -> bool:
    """Whether a line is printed as a running head or page number of the page."""
    line = line.strip()
    if not line or len(line) > 90 or page_num is None or re.search(r"[.!?;,]$", line) and not re.search(r"\d\.?$", line):
        return False
    number = str(page_num + 1)
    marked = re.sub(rf"(?<![^\W_]){number}(?![^\W_])", "N", line) if number in line else line
    if marked == line:
        # The number itself may be misread.
        pieces = re.split(r"(\s+)", line)
        for k in (0, len(pieces) - 1):
            if re.search(r"\d", pieces[k]) and re.sub(r"\W", "", pieces[k].translate(_DIGIT_READINGS)) == number:
                pieces[k] = "N"
        marked = "".join(pieces)
    if re.search(r"\sN$", marked) and marked.upper() == marked and re.search(r"[^\W\d_]{2}", marked[:-1]):
        return True  # a title in capitals, then the number
    return _RUNNING.fullmatch(marked) is not None and ("N" in marked or "|" in marked)


def body_lines(raw_html: str | None) -> list[str]:
    """Lines of the blocks of a page that are body text, short ones only; lists, tables, code and headings left out."""
    lines: list[str] = []
    for attrs, content in _BLOCK.findall(raw_html or ""):
        label = _LABEL.search(attrs)
        if label and label[1] in ("Page-Header", "Page-Footer", "Table", "List-Group", "Code-Block", "Equation-Block", "Section-Header", "Form", "Diagram", "Chemical-Block", "Table-Of-Contents"):
            continue
        for line in re.split(r"</p>|<br ?/?>|\n", content):
            text = _TAG.sub("", line).strip()
            if text and len(text) <= 90:
                lines.append(text)
    return lines


def _plain(text: str) -> str:
    return re.sub(r"[\W_]+", "", text).lower()


NOISE_SCHEMA = "doc_id string, page_num int, hyphenated int, misread int, running_lines int, text string"


def _broken_at_line_ends(text: str) -> Iterator[tuple[str, str]]:
    for m in _LINE_END.finditer(text):
        at = m.start()
        while at and (text[at - 1].isalnum() or text[at - 1] in "'’-"):
            at -= 1
        left = _LEFT.search(text, at, m.start())
        if left:
            yield left[0], m[1]


def line_breaks(raw: str | None) -> Iterator[tuple[str, str]]:
    """What stands on both sides of every hyphen at a line end of the body of a page."""
    if raw and _LINE_END.search(raw):
        for content in re.sub(r"<(pre|code|math)\b.*?</\1>", " ", raw, flags=re.S).split("</div>"):
            if 'data-label="Page-' not in content:
                yield from _broken_at_line_ends(content)


def _page(raw: str | None, markdown: str | None, page_num: int | None, repairer: Repairer, keep_text: bool) -> tuple[int, int, int, str | None]:
    broken = sum(repairer.broken(a, b) for a, b in line_breaks(raw))
    wrong, texts = 0, []
    running: list[str] = []
    if markdown:
        there = {_plain(x) for x in markdown.split("\n")}
        running = [x for x in body_lines(raw) if is_running_line(x, page_num) and _plain(x) in there]
        for paragraph in paragraphs(markdown):
            if is_running_line(paragraph, page_num):
                continue
            text, n = repairer.paragraph(paragraph)
            wrong += n
            if keep_text:
                texts.append(text)
    return broken, wrong, len(running), "\n\n".join(texts) if keep_text else None


def repair(pages: DataFrame, keep_text: bool = True) -> DataFrame:
    """Noise of every page, and its running text in repaired, continuous paragraphs.

    Columns: doc_id, page_num, hyphenated (words broken at line ends), misread (words with wrong letters),
    running_lines, text. Null and empty pages have counts of 0 and an empty text; repeated rows give repeated rows.
    """
    pages = pages.select("doc_id", "page_num", "raw_html", "markdown")
    spark = pages.sparkSession
    words, pairs = count_words(pages)
    lexicon = cut_lineage(candidates(words))
    sizes = lexicon.agg(F.coalesce(F.sum(_held()), F.lit(0)).alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    cached = (_most_frequent(lexicon, CACHE_WORDS) if sizes["words"] > CACHE_WORDS else lexicon).select("word", "n", "c1", "c2", F.col("more.word").alias("more")).toPandas()
    noise = channel(lexicon, sizes["total"])
    cache = {w: (n, c1, c2, *more) for w, n, c1, c2, more in cached.itertuples(index=False)}
    shared = spark.sparkContext.broadcast((cache, sizes["total"], noise))  # bounded by CACHE_WORDS
    keyed = pages.withColumns({"k1": F.xxhash64(*_PAGE), "k2": F.xxhash64(F.lit(1), *_PAGE)})
    keyed = _with_rare_words(keyed, lexicon, shared) if sizes["words"] > CACHE_WORDS else keyed.withColumn("rare", F.lit(None).cast(_RARE))

    def repairer_of(rare: object, base: Repairer) -> Repairer:
        if rare is None or not len(rare):
            return base
        own = base.lexicon
        offered = {c: (n, None, None) for r in rare for c, n in ((r["c1"], r["n1"]), (r["c2"], r["n2"]), *((o["word"], o["n"]) for o in r["more"])) if c and c not in own}
        entries = {r["word"]: (r["n"], r["c1"], r["c2"], *(o["word"] for o in r["more"])) for r in rare}
        return Repairer(ChainMap({**offered, **entries}, own), base.pairs, base.total, base.noise, base.doubtful)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = Repairer(shared.value[0], Pairs(np.zeros(0, np.int64), np.zeros(0, np.int64)), *shared.value[1:])
        for part in batches:
            rows = [(k1, k2, sorted(own)) for k1, k2, raw, markdown, rare in part.itertuples(index=False) if (own := repairer_of(rare, base).asks(raw, markdown))]
            yield pd.DataFrame(rows, columns=["k1", "k2", "pairs"])

    asked = cut_lineage(keyed.select("k1", "k2", "raw_html", "markdown", "rare").mapInPandas(ask, "k1 bigint, k2 bigint, pairs array<bigint>"))
    each = asked.select("k1", "k2", F.explode("pairs").alias("pair"))
    answers = cut_lineage(pairs.join(each.select("pair").distinct(), "pair", "left_semi"))
    few = answers.count() <= CACHE_PAIRS
    counts = answers.toPandas().sort_values("pair") if few else pd.DataFrame({"pair": [], "n": []})
    known = spark.sparkContext.broadcast((counts["pair"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)))  # bounded by CACHE_PAIRS
    if few:
        ready = keyed.withColumn("own_pairs", F.lit(None).cast("array<struct<pair: bigint, n: bigint>>"))
    else:
        own = each.distinct().join(answers, "pair").groupBy("k1", "k2").agg(F.collect_list(F.struct("pair", "n")).alias("own_pairs"))
        ready = keyed.join(own, ["k1", "k2"], "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = Repairer(shared.value[0], Pairs(*known.value), *shared.value[1:])
        for part in batches:
            rows = []
            for doc, num, raw, markdown, rare, more in part.itertuples(index=False):
                number = None if pd.isna(num) else int(num)
                own = repairer_of(rare, base)
                if more is not None and len(more):
                    own = Repairer(own.lexicon, Pairs(*known.value, {r["pair"]: r["n"] for r in more}), own.total, own.noise, own.doubtful)
                rows.append((doc, number, *_page(raw, markdown, number, own, keep_text)))
            yield pd.DataFrame(rows, columns=["doc_id", "page_num", "hyphenated", "misread", "running_lines", "text"]).astype({"page_num": "Int32"})

    return ready.select("doc_id", "page_num", "raw_html", "markdown", "rare", "own_pairs").mapInPandas(run, NOISE_SCHEMA)


#: What names a page, by two hashes of 64 bits.
_PAGE = ("doc_id", "page_num", "raw_html", "markdown")
_OFFERS = "array<struct<word: string, n: bigint>>"
_RARE = f"array<struct<word: string, n: bigint, c1: string, n1: bigint, c2: string, n2: bigint, more: {_OFFERS}>>"


def _held() -> Column:
    """What an entry of the lexicon counts for among those sent to the workers."""
    return 1 + F.size("more")


def _most_frequent(lexicon: DataFrame, size: int) -> DataFrame:
    """The most frequent words, none passed over, that hold ``size`` words and further candidates at most."""
    falling = [F.col("n").desc(), F.col("word")]
    up_to = F.sum(_held()).over(Window.orderBy(*falling).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return lexicon.orderBy(*falling).limit(size).withColumn("up_to", up_to).where(F.col("up_to") <= size).drop("up_to")


def _broken_words(left: str, right: str) -> list[str]:
    """Words that Repairer.broken looks up."""
    a, b = left.lower().rsplit("-", 1)[-1], right.lower()
    return [a, b, a + b, (left + right).lower()]


def _needed_words(markdown: str | None, raw: str | None, cache: dict) -> set[str]:
    """Words that repairing a page may look up: its own, and those that its parts, letters and broken words make up."""
    needed: set[str] = set()
    for words in _running_words(markdown):
        needed.update(words)
        needed.update(a + b for a, b in zip(words, words[1:]) if a not in cache or b not in cache)
    if markdown:
        for paragraph in paragraphs(markdown):
            needed.update((m[1] + m[2]).lower() for m in _SOFT_BREAK.finditer(paragraph))
            for m in _SPACED.finditer(paragraph):
                word = m[0].replace(" ", "").lower()
                needed.update([word[1:], *(word[:k] for k in range(1, len(word) + 1)), *(word[k:] for k in range(1, len(word)))])
        needed.update(w for m in _SOFT_BREAK.finditer(markdown) for w in (m[1].lower(), m[2].lower()))
    # Both parts of words that may be joined up, which are rarer than their parts.
    for word in [w for w in needed if len(w) >= 5 and w not in cache and w.isalpha()]:
        needed.update(part for k in range(1, len(word)) for part in (word[:k], word[k:]))
    needed.update(w for a, b in _broken_at_line_ends(raw or "") for w in _broken_words(a, b))
    return needed


def _with_rare_words(pages: DataFrame, lexicon: DataFrame, shared: object) -> DataFrame:
    """Pages with the lexicon entries of those of their words that aren't in the broadcast."""

    @F.pandas_udf("array<string>")
    def missing(texts: pd.Series, raws: pd.Series) -> pd.Series:
        cache = shared.value[0]
        return pd.Series([sorted(w for w in _needed_words(t, r, cache) if w not in cache) for t, r in zip(texts, raws)], dtype=object)

    needed = pages.select("k1", "k2", F.explode(missing("markdown", "raw_html")).alias("word")).distinct()
    found = needed.join(lexicon, "word").groupBy("k1", "k2").agg(F.collect_list(F.struct("word", "n", "c1", "n1", "c2", "n2", "more")).alias("rare"))
    return pages.join(found, ["k1", "k2"], "left")


def page_noise(pages: DataFrame) -> DataFrame:
    """One row per page and kind of noise: doc_id, page_num, noise."""
    found = repair(pages, keep_text=False)
    kinds = F.array_compact(
        F.array(
            F.when(F.col("hyphenated") > 0, "hyphenation"),
            F.when(F.col("misread") >= MISREAD_WORDS, "misread"),
            F.when(F.col("running_lines") > 0, "running_line"),
        )
    )
    return found.select("doc_id", "page_num", F.explode(kinds).alias("noise")).distinct()
