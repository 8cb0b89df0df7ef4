from __future__ import annotations

import random

from quirework.llm import truncation as tr

SCHEMA = "request_id bigint, source string, raw string, token_count int, chars int"
WORDS = "table of ledger copies kept near Orvane shows that every margin note was read again by some clerk in the evening".split()


def page(rng, words, whole=True):
    out = []
    for _ in range(words // 12 + 1):
        text = " ".join(rng.choice(WORDS) for _ in range(12)).capitalize() + "."
        out.append(f'<div data-bbox="1 2 3 4" data-label="Text"><p>{text}</p></div>')
    if not whole:
        out[-1] = '<div data-bbox="1 2 3 4" data-label="Text"><p>The last sentence of this page runs on to the</p></div>'
    return "\n".join(out) + '\n<div data-bbox="1 2 3 4" data-label="Page-Footer">7</div>'


def corpus(rng):
    rows, truth = [], set()
    for k in range(400):
        raw = page(rng, rng.randint(30, 200 if k % 4 else 60), k % 9 > 0)
        rows.append((k, f"s{k % 4}", raw, round(len(raw) / 3.5)))
    for k in range(400, 430):  # storage cuts at 1200 characters
        raw = page(rng, 300)
        rows.append((k, "s0", raw[:1200], round(len(raw) / 3.5)))
        truth.add(k)
    for k in range(430, 440):  # the transfer broke
        raw = page(rng, 100)
        rows.append((k, "s1", raw[: rng.randint(100, 400)], round(len(raw) / 3.5)))
        truth.add(k)
    for k in range(440, 445):  # broke, and was closed again
        raw = '<div data-bbox="1 2 3 4" data-label="Text"><p>' + " ".join(rng.choice(WORDS) for _ in range(50)) + " led</p></div>"
        rows.append((k, "s2", raw, round(len(raw) / 3.5 * 1.4)))
        truth.add(k)
    rows += [(500, "s3", None, 0), (501, "s3", "", 0), (502, None, page(rng, 50), None), (503, "s3", "no markup at all", 5)]
    return rows, truth


def test_verdicts_limits_and_rates(spark):
    rows, truth = corpus(random.Random(4))
    df = spark.createDataFrame([(*r, None) for r in rows + rows[:50]], SCHEMA)
    got = {r["request_id"]: r for r in tr.truncation(df).collect()}
    assert {k for k, r in got.items() if r["truncated"]} == truth
    assert 500 not in got and 501 not in got and got[502]["source"] == "" and len(got) == len(rows) - 2
    found = {(r["source"], r["measure"], r["limit_value"]) for r in tr.limits(tr.describe(df)).collect()}
    assert ("s0", "chars", 1200) in found and not any(s == "s3" for s, _, _ in found)
    at_limit = {k for k, r in got.items() if r["reason"] == "at a limit"}  # one may be cut where it looks whole
    assert at_limit <= set(range(400, 430)) and len(at_limit) >= 29
    rates = {r["source"]: r for r in tr.truncation_rates(df).collect()}
    assert (rates["s0"]["n_at_limit"], rates["s1"]["n_open"], rates["s2"]["n_broken"] + rates["s2"]["n_surplus"]) == (len(at_limit), 10, 5)
    assert rates["s0"]["n_truncated"] == 30 and rates["s1"]["n_truncated"] == 10 and rates["s3"]["rate"] == 0


def test_empty_and_very_long(spark):
    assert tr.truncation(spark.createDataFrame([], SCHEMA)).count() == 0
    long = '<div data-label="Page-Footer">' + "<b>x</b>" * 100_000 + "</div>"
    assert tr.truncation(spark.createDataFrame([(1, "s", long, 5, 1)], SCHEMA)).first()["truncated"] is False


def test_limits_stand_at_the_maximum(spark):
    def value(n, whole):
        text = f'<div data-bbox="1 2 3 4" data-label="Text"><p>a b {"x" * n}'
        return text[: n - 11] + ".</p></div>" if whole else text[:n]

    rows = [(k, "common", value(61, False), 20) for k in range(50)]  # a short answer that many have is no limit
    rows += [(100 + k, "common", value(300 + 7 * k, True), 200) for k in range(100)]
    rows += [(300 + k, "cut", value(900, False), 400) for k in range(20)] + [(400 + k, "cut", value(100 + 7 * k, True), 200) for k in range(100)]
    rows += [(600, "cut", value(1500, True), 500)]  # one value came through uncut
    found = {(r["source"], r["measure"], r["limit_value"]) for r in tr.limits(tr.describe(spark.createDataFrame([(*r, None) for r in rows], SCHEMA))).collect()}
    assert ("cut", "chars", 900) in found and not any(s == "common" for s, *_ in found)


def test_endings():
    div = '<div data-bbox="1 2 3 4" data-label="Text"><p>%s</p></div>'
    whole = [div % "It ends here." + "\n", div % "It ends here.", "plain", div % "A title", '<div data-label="Table"><table><tr><td>a b c</td></tr></table></div>\n\n']
    for raw in whole:
        _, _, opened, _, terminal, midway, *_ = tr.describe_text(raw)
        assert not opened and (terminal or not midway or "<table>" in raw), raw
    assert tr.describe_text(div % "It stops in the mid")[5] and tr.describe_text((div % "It stops in the mid") + '<div data-label="Page-Footer">12</div>')[6] == "mid"
    assert tr.describe_text('<div data-bbox="1"><p>It stops')[2] and not tr.describe_text("It stops <b>")[2]
    assert tr.describe_text("жук " * 10)[:2] == (40, 70) and tr.describe_text("жук " * 10)[7] == "9/0/0"


def test_whole_answers_that_end_in_a_newline(spark):
    div = '<div data-bbox="1 2 3 4" data-label="Text"><p>%s</p></div>\n'
    rows = [(k, "s", div % " ".join(["This one is whole and ends here."] * (k % 7 + 4)), 60 * (k % 7 + 4) // 7, None) for k in range(60)]
    assert tr.truncation(spark.createDataFrame(rows, SCHEMA)).where("truncated").count() == 0


def test_repeated_rows_and_null_ids(spark):
    rows = [(None, "s", "one text.", 3, None), (None, "s", "two text.", 3, None), (None, "s", "two text.", 3, None)]
    assert tr.truncation(spark.createDataFrame(rows, SCHEMA)).count() == 2  # different texts of equal length


def test_broken_words_against_every_pair(spark):
    rng = random.Random(5)
    words = {"".join(rng.choices("ab", k=rng.randint(1, 12))): rng.choice([1, 2, 3, 50, 4000]) for _ in range(200)}
    asked = {"".join(rng.choices("ab", k=rng.randint(1, 12))) for _ in range(200)}
    want = set()
    for a in asked:
        uses = sum(n for w, n in words.items() if n >= tr.KNOWN and len(w) > len(a) and w.startswith(a))
        if uses and (words.get(a, 0) < tr.KNOWN or words[a] < tr.KNOWN_SHARE * uses):
            want.add(a)
    got = tr.broken_words(spark.createDataFrame(list(words.items()), "word string, n bigint"), spark.createDataFrame([(a,) for a in [*asked, ""]], "last_word string"))
    assert {r["last_word"] for r in got.collect()} == want and got.count() == len(want)


def test_very_long_words(spark):
    rows = [(1, "s", "<div data-label='Text'><p>one two " + "y" * 200_000 + "</p></div>", 5, None), (2, "s", "<b>" * 100_000, 5, None), (3, "s", "</b>" * 100_000, 5, None)]
    assert tr.truncation(spark.createDataFrame(rows, SCHEMA)).count() == 3
