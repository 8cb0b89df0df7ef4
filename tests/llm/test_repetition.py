from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirework.llm import repetition as rep


def brute(words: list[str]) -> list[bool]:
    """Covered words, straight from the definition."""
    n, covered = len(words), [False] * len(words)
    for i in range(n - 4):
        if any(words[j : j + 5] == words[i : i + 5] for j in range(i - 4)):
            covered[i : i + 5] = [True] * 5
    for unit in (1, 2, 3, 4):
        i = unit
        while i < n:
            k = i
            while k < n and words[k] == words[k - unit]:
                k += 1
            if k - i >= unit * 10:
                covered[i:k] = [True] * (k - i)
            i = max(k, i + 1)
    return covered


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("a bb c dd e".split()), max_size=60), min_size=1, max_size=4))
def test_against_brute_force(texts):
    got = rep.measure_texts([" ".join(t) for t in texts])
    for words, row in zip(texts, got.itertuples()):
        covered = brute(words)
        assert row.n_words == len(words)
        assert row.word_share == pytest.approx(sum(covered) / len(words) if words else 0)


def share(text):
    return rep.measure_texts([text])["word_share"][0]


SENTENCE = "the quick brown fox jumps over one lazy dog near the old river bank today"


def test_what_counts():
    assert share(None) == share("") == share("  \n") == 0
    assert share(SENTENCE) == 0
    assert share(SENTENCE + ". " + SENTENCE.upper() + "!") == pytest.approx(0.5)
    assert share("<p>" + SENTENCE.replace(" ", ", ") + "</p><p>" + SENTENCE + "</p>") == pytest.approx(0.5)
    assert share("1. one two three\n2. four five six\n3. seven eight") == 0
    assert share("na " * 200) > 0.95 and share("/ " * 200) > 0.9 and share("xyz" * 200) > 0.9 and share("□" * 300) > 0.9
    assert share("Chapter .............. 3\nIndex .............. 9\n" + SENTENCE) == 0
    assert share("a " * 10 + SENTENCE) < 0.5
    assert share((SENTENCE + " ") * 20_000) > 0.99  # a very long text


def test_hosts_and_verdicts(spark):
    rows = [("raw", f"h{h}", str(k), (SENTENCE + ". ") * (3 if k < bad else 1)) for h, bad in enumerate((0, 1, 30)) for k in range(40)]
    df = spark.createDataFrame(rows + [("raw", None, "n", None), ("raw", None, "n", None)], "field string, host string, record_key string, t string")
    made = rep.repetition(rep.measure(df, "t", {c: F.col(c) for c in ("field", "record_key", "host")}))
    got = {(r["host"], r["record_key"]): r for r in made.collect()}
    assert made.count() == 122 and got[("", "n")]["repetitive"] is False
    assert sum(r["repetitive"] for r in got.values()) == 31
    rates = {r["host"]: r for r in rep.host_rates(made).collect()}
    assert rates["h0"]["raw_failed"] == 0 < rates["h0"]["rate_failed"] < rates["h1"]["rate_failed"] < rates["h2"]["rate_failed"] < rates["h2"]["raw_failed"]
    assert rates["h2"]["n_failed_copies"] == 30 and rates["h2"]["n_failed_loops"] == 0
    assert got[("h2", "39")]["host_suspect"] and not got[("h0", "1")]["host_suspect"]


def borderline(above):
    """A text whose share of repetition is a little above or below the threshold."""
    words = [f"w{k:04d}" for k in range(1000)]
    n = 302 if above else 298
    return " ".join([*words[: 1000 - n], *words[:n]])


def test_hosts_decide_values_near_the_threshold(spark):
    rows = []
    for host, bad in (("clean", 0), ("spam", 40)):
        rows += [("raw", host, f"{host}{k}", (SENTENCE + ". ") * (3 if k < bad else 1)) for k in range(50)]
        rows += [("raw", host, f"{host}-{above}", borderline(above)) for above in (True, False)]
        rows += [("raw", host, f"{host}-far-{n}", " ".join(f"w{k}" for k in [*range(1000 - n), *range(n)])) for n in (100, 450)]
    df = spark.createDataFrame(rows, "field string, host string, record_key string, t string")
    measured = rep.measure(df, "t", {c: F.col(c) for c in ("field", "record_key", "host")})
    got = {r["record_key"]: r for r in rep.repetition(measured).collect()}
    assert got["spam-False"]["repetitive"] and not got["spam-False"]["failed"]  # its host speaks against it
    assert not got["clean-True"]["repetitive"] and got["clean-True"]["failed"]  # and for this one
    assert got["spam-True"]["repetitive"] and not got["clean-False"]["repetitive"]
    for host in ("clean", "spam"):  # far from the threshold no host decides
        assert got[f"{host}-far-450"]["repetitive"] and not got[f"{host}-far-100"]["repetitive"]


def test_hot_and_small_hosts_are_joined_alike(spark, monkeypatch):
    rows = [("raw", f"h{k % 7}" if k % 3 else "hot", str(k), (SENTENCE + ". ") * (1 + k % 2)) for k in range(60)]
    measured = rep.measure(spark.createDataFrame(rows, "field string, host string, record_key string, t string"), "t", {c: F.col(c) for c in ("field", "record_key", "host")})
    want = sorted(map(tuple, rep.repetition(measured).collect()))
    for part in (0.2, 2.0):
        monkeypatch.setattr(rep, "HOT_PART", part)
        assert sorted(map(tuple, rep.repetition(measured).collect())) == want and len(want) == 60


def test_unspaced_scripts_lines_and_phrases():
    chinese = "山上的老人每天清晨都会走到河边去看那些慢慢飘过的旧木船。"
    assert share(chinese) == 0 and share(chinese * 4) == pytest.approx(0.75, abs=0.02)
    assert share("今天我们去。明天我们去。") == 0  # a small natural repeat
    made = rep.measure_texts([" ".join(f"buy it here now w{k}" for k in range(60)), "a b\nc d\na b\n\na b", "p q\n\nr s\n\np q", None, ""])
    assert made["word_share"][0] == 0 and made["phrase_share"][0] == pytest.approx(59 * 4 / 300)
    assert made["line_share"][1] == pytest.approx(6 / 12) and made["block_share"][2] == pytest.approx(3 / 9)
    assert made.loc[3:, "word_share":].to_numpy().sum() == 0


def test_whole_tables(spark):
    art = spark.createDataFrame([("d", 1, SENTENCE * 1, "x"), ("d", 2, (SENTENCE + " ") * 2, "x"), ("d", 2, (SENTENCE + " ") * 2, "x"), (None, None, None, None)], "doc_id string, page_num int, markdown string, host string")
    res = spark.createDataFrame([(7, "s", (SENTENCE + " ") * 3, "clash"), (8, None, "", None)], "request_id bigint, source string, raw string, _text string")
    found = rep.document_repetition(art, res).where("repetitive").select("field", "record_key").distinct()
    assert sorted(map(tuple, found.collect())) == [("markdown", "d/2"), ("raw", "7")]
    assert rep.document_repetition(art.limit(0), res.limit(0)).count() == 0
