from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirework.llm import scan_noise as sn

SENTENCES = [
    "The chief auditor priced the ledger below par and the harbour master signed for the invoice in the evening.",
    "Several pages describe the turbine in detail while the design office tested the flange at seventy volts.",
    "Nobody had expected the treaty to matter before the second printing of the chronicle came from the abbey.",
    "A home cook simmered the broth until tender and the baker served the custard with warm bread after dinner.",
]


def block(text, label="Text"):
    return f'<div data-bbox="1 2 3 4" data-label="{label}"><p>{text}</p></div>'


def corpus(spark, extra):
    rng = random.Random(8)
    rows = []
    for k in range(300):
        text = " ".join(rng.sample(SENTENCES, 3))
        rows.append((f"d{k % 7}", k, block(text), text))
    for num, raw, text in extra:
        rows.append(("x", num, raw, text))
    return spark.createDataFrame([(*r, 0, "w") for r in rows], "doc_id string, page_num int, raw_html string, markdown string, rare int, word string")


def page(num, text, md=None):
    return (num, block(text), md if md is not None else text)


NOISY = "Thc chief auditor priced the 1edger below par and the harb0ur master signed for the invoice in the evening."
EXTRA = [
    page(1, NOISY), page(2, "The chief auditor priced the 1edger below par and the harbour master signed for the invoicc in the evening."),
    page(3, "Several pages des-\ncribe the turbine in detail while the design office tested the flange at seventy volts.", "Several pages des- cribe the turbine in detail while the design office tested the flange at seventy volts."),
    page(4, "Both pre- and post-war copies are kept while the design office tested the flange in the evening."),
    (5, block("6") + block(SENTENCES[0]), "6\n\n" + SENTENCES[0]), (6, block("– 7 –", "Page-Header") + block(SENTENCES[0]), SENTENCES[0]),
    (7, block("A second look | verso") + block(SENTENCES[1]), "A second look | verso\n\n" + SENTENCES[1]), (8, block("THE HARBOUR LEDGER 9") + block(SENTENCES[1]), "THE HARBOUR LEDGER 9\n\n" + SENTENCES[1]),
    page(9, "The c h i e f auditor priced the l e d g e r below par and the h a r b o u r master signed for the invoice."), (10, None, None), (11, "", ""), (12, block("42 grams of flour"), "42 grams of flour"),
    page(13, "N0body had expectcd the treafy to matter before the sec-\nond printing of the chronicle came from the abbey."),
]


def test_kinds(spark):
    found = sorted(map(tuple, sn.page_noise(corpus(spark, EXTRA)).collect()))
    assert found == [
        ("x", 1, "misread"), ("x", 3, "hyphenation"), ("x", 5, "running_line"), ("x", 7, "running_line"), ("x", 8, "running_line"), ("x", 9, "misread"), ("x", 13, "hyphenation"), ("x", 13, "misread"),
    ]


def test_confusions_of_all_pairs_count(spark):
    usual = [(f"thc{k}", 9, f"the{k}") for k in range(20_500)]  # one language's pairs come first
    rare = [(f"я{k}п", 1, f"я{k}и") for k in range(300)]
    lexicon = spark.createDataFrame([*usual, *rare, ("plain", 50, None)], "word string, n bigint, c1 string")
    noise = sn.channel(lexicon, 1_000_000)
    assert set(noise) == {("e", "c"), ("и", "п")}
    assert noise["e", "c"] == pytest.approx(np.log((20_500 * 9 + 1) / 1_001_000)) and noise["и", "п"] == pytest.approx(np.log(301 / 1_001_000))


def test_repaired_text_and_rare_words_by_join(spark, monkeypatch):
    df = corpus(spark, EXTRA)
    whole = {(r["doc_id"], r["page_num"]): r["text"] for r in sn.repair(df).collect()}
    assert whole["x", 1] == SENTENCES[0] and whole["x", 3] == SENTENCES[1] and whole["x", 13] == SENTENCES[2]
    assert whole["x", 5] == SENTENCES[0] and whole["x", 9].startswith("The chief auditor priced the ledger below") and whole["x", 10] == whole["x", 11] == ""
    monkeypatch.setattr(sn, "CACHE_WORDS", 40)
    joined = {(r["doc_id"], r["page_num"]): r["text"] for r in sn.repair(df).collect()}
    assert joined == whole


def test_rare_words_of_line_breaks_and_joined_words_by_join(spark, monkeypatch):
    # The break stands in raw_html only; its parts and the parts of the joined-up word are beyond the broadcast.
    extra = [(20, block("The simmer-\ned broth."), "Nothing of it."), page(21, "The bakerserved custardwith breadafter auditorpriced.")]
    df = corpus(spark, extra)
    whole = {(r["doc_id"], r["page_num"]): (r["hyphenated"], r["misread"], r["text"]) for r in sn.repair(df).collect()}
    assert whole["x", 20][0] == 1
    monkeypatch.setattr(sn, "CACHE_WORDS", 3)
    assert {(r["doc_id"], r["page_num"]): (r["hyphenated"], r["misread"], r["text"]) for r in sn.repair(df).collect()} == whole
    cache = {"the": (1, None, None)}
    needed = sn._needed_words("The bakerserved the custard with warm bread after dinner.", block("sim-\nmered"), cache)
    assert {"baker", "served", "sim", "mered", "simmered"} <= needed


def test_empty_table(spark):
    df = corpus(spark, [])
    assert sn.page_noise(df.limit(0)).count() == 0 and sn.repair(df.where("page_num < 0")).count() == 0
    twice = df.limit(2).union(df.limit(2))
    assert sn.repair(twice).count() == 4


def repairer():
    words = {"the": 900, "ledger": 100, "leader": 90, "a": 500, "tor": 60, "for": 700}
    lexicon = {w: (n, None, None) for w, n in words.items()} | {"1edger": (1, "ledger", None), "1eader": (1, "leader", "ledger"), "tbe": (2, "the", None)}
    pairs = sn.Pairs.of({("the", "ledger"): 60, ("a", "leader"): 70, ("for", "the"): 200, ("", "the"): 50})
    return sn.Repairer(lexicon, pairs, 2500, {("l", "1"): -7.0, ("h", "b"): -7.0, ("a", "d"): -12.0})


@pytest.mark.parametrize("words", [["for", "tbe", "1edger"], ["a", "1eader"], ["the", "1eader", "1edger"], ["tbe"], ["unknown", "1edger", "tbe", "a"]])
def test_viterbi_against_all_readings(words):
    r = repairer()

    def score(choice):
        total, before = 0.0, ""
        for k, (word, option) in enumerate(zip(words, choice)):
            many = len(r.options(word)) > 1
            free = k > 0 and len(r.options(words[k - 1])) > 1
            total += (r._emission(word, option) if many else 0.0) + (r._transition(before, option) if many or free else 0.0)
            before = option
        return total

    best = max(itertools.product(*map(r.options, words)), key=score)
    assert r.decode(words) == list(best)
    assert r.decode(["for", "tbe", "1edger"]) == ["for", "the", "ledger"] and r.decode(["for", "the"]) == ["for", "the"]


@pytest.mark.parametrize(("a", "b"), [("modern", "modem"), ("the", "tbe"), ("dark", "clark"), ("under", "iinder"), ("still", "stíll"), ("case", "ca5e"), ("quit", "guif"), ("win", "vvin"), ("will", "wi1l")])
def test_skeletons_meet(a, b):
    assert sn.skeleton(a) == sn.skeleton(b)


def test_skeletons_part():
    assert sn.skeleton("ledger") != sn.skeleton("lodger") and sn.skeleton("") == ""


@pytest.mark.parametrize(
    ("line", "num", "yes"),
    [("– 25 –", 24, True), ("[3]", 2, True), ("p. 602", 601, True), ("Page 2 of 23", 1, True), ("22   La copia 33", 21, True), ("O QUADRO 40 7", 6, True), ("Appendix 4 | recto", 8, True), ("26", 25, True), ("26", 3, False), ("Le bilan 11", 3, False),
     ("Lane 20", 3, False), ("", 0, False), ("He was 7.", 6, False), ("5", None, False), ("Tarwexka Lane 20", 18, False), ("Page 1 0f 6", 0, False)],
)
def test_running_lines(line, num, yes):
    assert sn.is_running_line(line, num) is yes


def test_counts_are_of_all_pages(spark):
    df = corpus(spark, [])
    words, pairs = sn.count_words(df)
    got = {r["word"]: r["n"] for r in words.collect()}
    text = " ".join(r["markdown"] for r in df.select(F.col("markdown")).collect()).lower()
    assert got["the"] == text.split().count("the")
    counted = {r["pair"]: r["n"] for r in pairs.collect()}
    key = sn.Pairs.of({}).key
    assert counted[key("the", "ledger")] == text.count("the ledger") and counted[key("", "the")] + counted[key("", "several")] + counted[key("", "nobody")] + counted[key("", "a")] == 300
    assert key("ledger", "the") not in counted


def test_pairs_are_exact_and_asked_for(spark, monkeypatch):
    df = corpus(spark, [*EXTRA, page(30, "The bakerserved the custard with warm bread after dinner."), page(31, "The har bour master signed the 1edger-\nbook.", "The har bour master signed the 1edger- book.")])
    asked: list[tuple[str, str]] = []
    words, pairs = sn.count_words(df)
    counts = {r["pair"]: r["n"] for r in pairs.collect()}
    lexicon = {r["word"]: (r["n"], r["c1"], r["c2"]) for r in sn.candidates(words).collect()}

    class Watching(sn.Pairs):
        def count(self, a, b):
            asked.append((a, b))
            return super().count(a, b)

    everything = Watching(np.array(sorted(counts), np.int64), np.array([counts[k] for k in sorted(counts)], np.int64))
    repairer = sn.Repairer(lexicon, everything, sum(n for n, *_ in lexicon.values()), {})
    for r in df.collect():
        asked.clear()
        own = repairer.asks(r["raw_html"], r["markdown"])
        assert not asked
        sn._page(r["raw_html"], r["markdown"], r["page_num"], repairer, True)
        assert {everything.key(a, b) for a, b in asked} <= own  # all it weighs has been asked for
    whole = {(r["doc_id"], r["page_num"]): tuple(r) for r in sn.repair(df).collect()}
    for words_sent, pairs_sent in ((3, 0), (10**6, 0), (3, 10**6)):
        monkeypatch.setattr(sn, "CACHE_WORDS", words_sent)
        monkeypatch.setattr(sn, "CACHE_PAIRS", pairs_sent)
        assert {(r["doc_id"], r["page_num"]): tuple(r) for r in sn.repair(df).collect()} == whole


def test_frequencies_decide_not_sizes():
    """The same corpus a thousand times over: the same verdicts."""
    for times in (1, 1000):
        lexicon = {w: (n * times, None, None) for w, n in {"of": 9000, "the": 20000, "can": 900, "not": 2500, "ofthe": 30, "cannot": 400, "har": 2, "bour": 2, "harbour": 80}.items()}
        pairs = sn.Pairs.of({("of", "the"): 5000 * times, ("can", "not"): 300 * times, ("har", "bour"): 2 * times})
        r = sn.Repairer(lexicon, pairs, 40_000 * times, {})
        assert r.split_joined("ofthe") == ("of", "the") and r.split_joined("cannot") is None
        assert r.paragraph("of the har bour of the can not the.") == ("of the harbour of the can not the.", 1)


def lexicon_of(spark, counts):
    rows = sn.candidates(spark.createDataFrame(list(counts.items()), "word string, n bigint")).collect()
    return {r["word"]: [(w, n) for w, n in ((r["c1"], r["n1"]), (r["c2"], r["n2"]), *map(tuple, r["more"])) if w] for r in rows}


def test_all_candidates(spark):
    """Every frequent word of the skeleton is offered; neither misreadings of the first nor barred accents take a place."""
    counts = {"fall": 9000, "tail": 8000, "tall": 7000, "fail": 6000, "fáll": 900, "ta1l": 1, "cópia": 246, "copia": 634, "cópía": 1, "hostel": 6000, "hostcl": 8, "bostel": 5, "h0stel": 1}
    found = lexicon_of(spark, counts)
    assert found["ta1l"] == [("fall", 9000), ("tail", 8000), ("tall", 7000), ("fail", 6000), ("fáll", 900)]
    assert found["cópía"] == [("cópia", 246)] and found["h0stel"] == found["hostcl"] == [("hostel", 6000)]
    assert found["fall"] == found["fail"] == found["hostel"] == []


def test_candidates_against_all_pairs(spark):
    rng = random.Random(3)
    counts = {"".join(rng.choices("hbéec8í1il", k=rng.choice((1, 2, 2, 3)))): int(10 ** rng.uniform(0, 6)) for _ in range(900)}
    bare, dotless = str.maketrans(*sn._ACCENTS), str.maketrans("íìï", "iii")
    sound: list[str] = []
    expected = {}
    for word, n in sorted(counts.items(), key=lambda x: (x[1], x[0]), reverse=True):
        mixed = any(a.isdigit() != b.isdigit() for a, b in zip(word, word[1:])) and word not in ("8h", "1h", "81h", "18h", "88h", "11h", "8e", "1e", "81e", "18e", "88e", "11e")
        least = sn.MIXED_RATIO * n if mixed else max(sn.RARE_RATIO * n, sn.RATIO * (n - np.sqrt(n)))
        expected[word] = [
            (c, counts[c]) for c in sound
            if len(word) > 1 and not word.isdigit() and sn.skeleton(c) == sn.skeleton(word) and counts[c] >= least and (c.translate(bare) != word.translate(bare) or c.translate(dotless) == word.translate(dotless))
        ]
        if not expected[word] and n >= sn.MIN_KNOWN and not any(map(str.isdigit, word)):
            sound.append(word)
    assert max(map(len, expected.values())) > 4
    assert lexicon_of(spark, counts) == expected


CHOICES = [
    page(1000 + k, text) for k, text in enumerate([
        *["Every autumn the leaves fall quietly beside the old garden wall."] * 40, *["Three ships with tall masts were lying there all winter long."] * 32,
        *["Old engines often fail without any warning on cold mornings."] * 26, *["The fox carried its bushy tail above the frozen grass."] * 20,
    ])
]


def test_fourth_candidate_is_read(spark, monkeypatch):
    df = corpus(spark, [*CHOICES, page(40, "The fox carried its bushy ta1l above the frozen grass."), page(41, "Old engines often fa1l without any warning on cold mornings.")])
    whole = {(r["doc_id"], r["page_num"]): tuple(r) for r in sn.repair(df).collect()}
    assert whole["x", 40][3:] == (1, 0, "The fox carried its bushy tail above the frozen grass.")
    assert whole["x", 41][3:] == (1, 0, "Old engines often fail without any warning on cold mornings.")
    for words_sent, pairs_sent in ((3, 10**6), (30, 0), (60, 10**6)):
        monkeypatch.setattr(sn, "CACHE_WORDS", words_sent)
        monkeypatch.setattr(sn, "CACHE_PAIRS", pairs_sent)
        assert {(r["doc_id"], r["page_num"]): tuple(r) for r in sn.repair(df).collect()} == whole


def test_further_candidates_count_in_the_broadcast(spark):
    counts = {"the": 10**6, "fall": 9000, "tail": 8000, "tall": 7000, "fail": 6000, "ta1l": 500, "table": 400, "ta11": 100}
    lexicon = sn.candidates(spark.createDataFrame(list(counts.items()), "word string, n bigint"))
    sent = {size: [r["word"] for r in sn._most_frequent(lexicon, size).collect()] for size in (2, 5, 7, 8, 100)}
    assert sent[2] == ["the", "fall"] and sent[5] == sent[7] == ["the", "fall", "tail", "tall", "fail"] and sent[8] == [*sent[7], "ta1l"] and len(sent[100]) == len(counts)


@pytest.mark.parametrize("words", [["the", "1edger"], ["the", "1edger", "stands"], ["1edger", "lcdger"], ["a", "1edger", "for"]])
def test_candidates_with_candidates_never_win(words):
    known = {"the": (900, None, None), "stands": (50, None, None), "ledger": (500, None, None), "leader": (450, None, None), "lcdger": (9, "ledger", None)}
    pairs = sn.Pairs.of({("the", "lcdger"): 9, ("lcdger", "stands"): 9, ("the", "leader"): 40, ("", "leader"): 3, ("a", "lcdger"): 5})
    decoded = [sn.Repairer(known | {"1edger": (1, *offers)}, pairs, 3000, {("l", "1"): -7.0, ("dg", "ad"): -5.0}).decode(words) for offers in (("ledger", "lcdger", "leader"), ("ledger", "leader"))]
    assert decoded[0] == decoded[1]
