from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quirework.llm import leakage as lk


def slow_tiles(text, unit, shortest):
    """The longest common run of unmarked words, again and again."""
    used_text, used_unit, found = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(text)):
            for j in range(len(unit)):
                k = 0
                while i + k < len(text) and j + k < len(unit) and text[i + k] == unit[j + k] and i + k not in used_text and j + k not in used_unit:
                    k += 1
                if k > best[2]:
                    best = (i, j, k)
        if best[2] < shortest:
            return sorted(found)
        found.append(best)
        used_text |= set(range(best[0], best[0] + best[2]))
        used_unit |= set(range(best[1], best[1] + best[2]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=14), st.lists(st.integers(1, 4), max_size=14))
def test_tiles_against_the_slow_way(text, unit):
    got, want = lk.tiles(text, unit, 2), slow_tiles(text, unit, 2)
    # Ties may be broken differently: the lengths of the longest tiles agree, and no word is used twice.
    assert (max((k for *_, k in got), default=0)) == (max((k for *_, k in want), default=0))
    assert all(text[i : i + k] == unit[j : j + k] and k >= 2 for i, j, k in got)
    for part in (0, 1):
        spots = [x for t in got for x in range(t[part], t[part] + t[2])]
        assert len(spots) == len(set(spots))


@pytest.mark.parametrize(
    ("found", "run"),
    [([(0, 0, 15)], 15), ([(0, 0, 7), (8, 8, 7)], 15), ([(0, 0, 7), (9, 7, 8)], 0), ([(0, 0, 10), (10, 12, 14)], 26 if 2 * 8 <= 26 else 0), ([(0, 10, 9), (9, 0, 9)], 9), ([], 0), ([(0, 0, 6), (7, 7, 6), (14, 14, 20)], 34)],
)
def test_longest_run(found, run):
    got = lk.longest_run(found)
    assert got == run or (run == 0 and got < 15)


UNIT = "the crooked watchman traded that frozen thimble beneath seven ragged ribbons by lamplight while a weary fiddler counted twisted bells on top of their roof"


def leaks(text, unit=UNIT):
    units = lk.Units([unit], [[1]])
    return [run for _, _, run, *_ in lk.scan([lk.words_of(text)], units) if run >= lk.RUN_WORDS]


def test_what_counts():
    words = UNIT.split()
    assert leaks("before it " + UNIT.upper() + " after it") and leaks("x " + " ".join(words[3:18]) + " y")
    assert not leaks("x " + " ".join(words[3:17]) + " y") and not leaks(" ".join(words[:14])) and not leaks("")
    changed = words.copy()
    changed[6], changed[14] = "X", "Y"
    assert leaks(" ".join(changed))
    changed[10], changed[18], changed[3] = "Z", "Q", "R"
    assert not leaks(" ".join(changed))
    added = words[:8] + ["extra"] + words[8:16]
    assert leaks(" ".join(added))
    marked = UNIT.replace("frozen", "<b>fro-\nzen</b>").replace("ragged", "[ragged](#n-3)").replace(" beneath", ",\n\n1------------------------------------------------\n\nbeneath").replace("weary", "we¬\nary")
    assert leaks(marked)
    assert not leaks(" ".join(words[12:]) + " and then " + " ".join(words[:12]))  # each part is too short


def test_longest_stretch_against_every_pair():
    rng = random.Random(3)
    for _ in range(500):
        covered = np.array([rng.random() < 0.8 for _ in range(rng.randint(0, 30))], bool)
        best = 0
        for a in range(len(covered)):
            for b in range(a, len(covered)):
                if covered[a] and covered[b] and (~covered[a : b + 1]).sum() * 8 <= b - a + 1:
                    best = max(best, b - a + 1)
        assert lk.longest_stretch(covered) == best


@pytest.mark.parametrize("size", [5, 8, 10, 14])
def test_reordered_passages_leak(spark, size):
    """Passages in pieces, reversed and shuffled, beside texts of the same words in no order; by both ways."""
    rng = random.Random(size)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(vocabulary, k=60)), " ".join(rng.choices(vocabulary, k=4))) for k in range(20)]
    docs, truth = [], set()
    for d in range(100):
        item = d % 20
        words = items[item][1].split()
        pieces = [words[k : k + size] for k in range(0, 60 // size * size, size)]
        if d % 5 == 0:
            pieces = pieces[::-1]
        elif d % 5 == 1:
            rng.shuffle(pieces)
        elif d % 5 == 2:
            pieces = [[w] for w in rng.sample(words, 60)]
        else:
            pieces = [rng.choices(vocabulary, k=60)]
        if d % 5 < 2:
            truth.add((d, item))
        docs.append((d, " ".join([*rng.choices(vocabulary, k=20), *(w for p in pieces for w in p), *rng.choices(vocabulary, k=20)])))
    df, table = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, passage string, question string")
    found = lk.leaks(df, table)
    got = {(r["doc_id"], r["item_id"]): (r["run_words"], r["stretch_words"], r["coverage"]) for r in found.collect()}
    assert set(got) == truth and all(stretch >= lk.RUN_WORDS for _, stretch, _ in got.values())
    units, _, few = lk.material(table)
    assert few and sorted(map(tuple, lk.leaked_units(df, units, False).collect())) == sorted(map(tuple, lk.leaked_units(df, units, True).collect()))


def test_short_items_unspaced_scripts_and_pieces(spark):
    chinese = "山上的老人每天清晨都会走到河边去看那些慢慢飘过的旧木船"
    words = [f"w{k}" for k in range(80)]
    some = " ".join(" and ".join(" ".join(words[k : k + 6]) for k in (60, 0, 36, 18, 48, 10, 27)).split())
    items = spark.createDataFrame([(1, UNIT, "who traded that frozen thimble beneath seven ragged ribbons by lamplight last"), (2, chinese, None), (3, " ".join(words), "w70 w71 w72 w73")], "item_id bigint, passage string, question string")
    docs = [(1, "x who traded that frozen thimble beneath seven ragged ribbons by lamplight last y"), (2, "他说。" + chinese + "。然后"), (3, some), (4, " ".join(words[:24])), (5, "w70 w71 w72 w73"), (6, chinese[:12])]
    got = {(r["doc_id"], r["item_id"]): r for r in lk.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), items).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 3)}  # too few words: 5 and 6
    assert got[(1, 1)]["coverage"] == 1.0 and got[(1, 1)]["run_words"] < lk.RUN_WORDS and got[(2, 2)]["run_words"] == len(chinese)
    assert got[(3, 3)]["stretch_words"] < lk.RUN_WORDS and got[(3, 3)]["coverage"] > 0.5 and got[(4, 3)]["run_words"] == 24


def test_random_copies(spark):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(rng.choices(vocabulary, k=60)), " ".join(rng.choices(vocabulary, k=25)), None) for k in range(30)] + [(30, None, None, None), (31, "", " ", "x")]
    items.append((32, items[0][1], "another question", None))  # shares a passage
    docs, truth = [], set()
    for d in range(200):
        filler = lambda: " ".join(rng.choices(vocabulary, k=40))
        if d % 4 == 0:
            k = rng.randrange(30)
            source = items[k][1 + d % 2 if d % 8 else 1].split()
            n = rng.randint(15, len(source))
            at = rng.randint(0, len(source) - n)
            copy = source[at : at + n]
            for c in range(7, n - 7, 8):
                if c + 1 <= n // 8 * 8:
                    copy[c] = "CHANGED"
            changes = copy.count("CHANGED")
            if changes * 8 <= n:
                truth |= {(d, i) for i, *texts, _ in items if texts[0] and (" ".join(source) in texts)}
            docs.append((d, f"{filler()} {' '.join(copy)} {filler()}", 0))
        else:
            docs.append((d, filler(), 0))
    docs += [(1000, None, 0), (1001, "", 0), docs[0]]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int")
    table = spark.createDataFrame(items, "item_id bigint, passage string, question string, text string")
    got = {(r["doc_id"], r["item_id"]) for r in lk.leaks(df, table).collect()}
    assert truth <= got and len(got - truth) <= 3
    old = lk.BLOCK_CHARS
    lk.BLOCK_CHARS = 1500  # the material is too large to be sent out
    try:
        assert not lk.material(table)[2]
        assert {(r["doc_id"], r["item_id"]) for r in lk.leaks(df, table).collect()} == got
    finally:
        lk.BLOCK_CHARS = old
    assert lk.leaks(df, table.limit(0)).count() == 0 and lk.leaks(df.limit(0), table).count() == 0


def test_very_long_text():
    assert leaks("w " * 500_000 + UNIT + " w" * 500_000)


def test_verdicts_need_no_measure():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(60)]
    units = lk.Units([" ".join(rng.choices(vocabulary, k=40)) for _ in range(6)], list(range(6)))
    texts = []
    for _ in range(80):
        source = rng.choice(units.ids).tolist()
        names = {k: w for w, k in units.vocabulary.items()}
        at, n = rng.randrange(20), rng.randint(8, 20)
        copy = [names[k] for k in source[at : at + n]]
        if rng.random() < 0.5:
            copy[n // 2] = "other"
        texts.append([*rng.choices(vocabulary, k=15), *copy, *rng.choices(vocabulary, k=15)])
    whole, quick = ({(d, u) for d, u, run, stretch, _ in lk.scan(texts, units, m) if max(run, stretch) >= lk.RUN_WORDS} for m in (True, False))
    assert whole == quick and whole


def test_tiles_from_one_search_and_by_width(monkeypatch):
    rng = random.Random(5)
    for _ in range(400):
        kinds = rng.choice([1, 2, 4, 30])
        text, unit = ([rng.randint(low, kinds) for _ in range(rng.randint(0, 50))] for low in (0, 1))
        for shortest in (2, 4):
            with monkeypatch.context() as m:
                at_once = lk.tiles(text, unit, shortest)
                m.setattr(lk, "FEW_PAIRS", -1)
                by_width = lk.tiles(text, unit, shortest)
            assert at_once == by_width
    words = rng.choices(range(1, 200), k=300)
    with monkeypatch.context() as m:  # few pairs: no search by width
        m.setattr(lk, "_Rolling", None)
        assert lk.tiles(words, list(range(300, 400))) == [] and (20, 0, 60) in lk.tiles(words, words[20:80])
    assert lk.tiles([1] * 3000, [1] * 400) == [(0, 0, 400)]  # many pairs


def test_words_are_those_of_the_pattern():
    rng = random.Random(6)
    signs = [c for c in map(chr, range(128)) if c not in "-[]{}<>&\\"] + list("Kİßé山")
    for _ in range(3000):
        text = "".join(rng.choices(signs, k=12))
        assert lk.words_of(text) == lk._WORD.findall(text.lower())
