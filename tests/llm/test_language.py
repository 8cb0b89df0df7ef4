from __future__ import annotations

import math
import random
from collections import Counter
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quirework.llm import language as lg
from quirework.llm.prose import is_full, paragraphs, sentences

SAMPLES = {
    "en": "The clerk wrote down every name in the ledger. Nobody knew why the map had been moved to the harbour. It is easy to overlook the second table.",
    "de": "Niemand wusste, ob die Karte wirklich aus dem Archiv stammt. Auf dem Umschlag steht nur das Urteil, sonst ist er leer. Nach der Prüfung blieb nur die Zeichnung übrig.",
    "fr": "Personne ne savait si la liste venait vraiment du bureau. Malgré tous les efforts, la copie n'est plus lisible. Il ne faut pas oublier la lettre dans les archives.",
}


def slow_grams(text: str) -> Counter:
    letters = [c if c.isalpha() else " " for c in text.lower()]
    text = " " + " ".join("".join(letters).split()) + " "
    return Counter(text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1) if text[i : i + n].strip())


def slow_distance(text: str, profile: list[str]) -> float:
    counts = slow_grams(text)
    ranks = {g: k for k, g in enumerate(profile)}
    ordered = sorted(counts, key=lambda g: -counts[g])
    mean = {c: sum(k for k, g in enumerate(ordered) if counts[g] == c) / sum(counts[g] == c for g in ordered) for c in set(counts.values())}
    return sum(abs(ranks[g] - int(min(mean[counts[g]], lg.PROFILE))) if g in ranks else lg.PROFILE for g in counts) / (len(counts) * lg.PROFILE)


def test_distances_against_brute_force():
    frames, profiles = [], {}
    for lang, text in SAMPLES.items():
        codes, owner = lg._codes([text])
        grams, n = np.unique(lg._grams(codes, owner)[0], return_counts=True)
        frames.append(pd.DataFrame({"lang": lang, "gram": grams, "n": n}))
        names = {int(g): "".join(" " if (g >> s) & 2047 == 1 else chr((g >> s) & 2047) for s in (22, 11, 0) if (g >> s) & 2047) for g in grams}
        assert Counter({names[int(g)]: int(c) for g, c in zip(grams, n)}) == slow_grams(text)
        profiles[lang] = [names[int(g)] for g in pd.DataFrame({"g": grams, "n": n}).sort_values(["n", "g"], ascending=[False, True])["g"]]
    known = lg.Profiles.of(pd.concat(frames))
    texts = ["nobody knew the name of the clerk", "die Karte im Archiv", "la lettre, la liste", "", "12 !"]
    dist, size = known.distances(texts)
    for k, text in enumerate(texts[:3]):
        assert size[k] == len(slow_grams(text))
        for j, lang in enumerate(known.languages):
            assert math.isclose(dist[k, j], slow_distance(text, profiles[lang]), abs_tol=1e-9)
    assert size[3] == size[4] == 0 and (dist[3:] == 1).all()
    assert [known.languages[k] for k in dist[:3].argmin(axis=1)] == ["en", "de", "fr"]


@pytest.mark.parametrize(
    ("label", "lang"), [("EN", "en"), ("en-GB", "en"), (" German ", "de"), ("ger", "de"), ("pt_BR", "pt"), ("Dutch", "nl"), ("zxx", None), ("", None), (None, None), ("unknown", None), ("ru-RU", "ru"), ("Swedish", "swedish"), ("sv-SE", "sv"), ("??", None), ("n/a", None), ("fra", "fr")]
)
def test_labels(spark, label, lang):
    assert spark.createDataFrame([(label,)], "l string").select(lg.label_language(F.col("l"))).first()[0] == lang


def make(rng, lang, n):
    return " ".join(rng.sample(sentences(SAMPLES[lang]), k=3)[:n])


def tables(spark):
    rng, pages, labels = random.Random(5), [], []
    when = datetime(2024, 1, 1)
    for k in range(60):
        lang = ("en", "de", "fr")[k % 3]
        pages.append(("d", k, make(rng, lang, 3), "x"))
        labels.append(("d", k, {"en": "English", "de": "de-AT", "fr": "fra"}[lang], when, 1))
    pages += [("m", 0, make(rng, "en", 3) + "\n\n" + make(rng, "de", 2), ""), ("m", 1, make(rng, "en", 3) + "\n\n" + make(rng, "fr", 1), ""), ("m", 2, make(rng, "de", 3), ""), ("m", 2, make(rng, "de", 3), ""), ("m", 3, make(rng, "fr", 2), "")]
    pages += [("m", 4, None, ""), ("m", 5, "  ", ""), ("m", 6, "# Only\n\n- a\n- list\n\nOrvane Lane 20\nPellmoor", ""), ("m", 7, make(rng, "en", 2), "")]
    labels += [("m", 0, "en", when, 0), ("m", 1, "en", when, 0), ("m", 2, "fr", when, 0), ("m", 3, "zxx", when, 0), ("m", 7, "de", when, 0), ("m", 7, "en", datetime(2024, 2, 1), 0), ("m", 7, "en", datetime(2024, 2, 1), 0)]
    return spark.createDataFrame(pages, "doc_id string, page_num int, markdown string, label string"), spark.createDataFrame(labels, "doc_id string, page_num int, lang_label string, labelled_at timestamp, n int")


def test_pages(spark):
    pages, labels = tables(spark)
    got = sorted(map(tuple, lg.relabelled(pages, labels).collect()))
    assert got == [("m", 0, "de"), ("m", 0, "en"), ("m", 2, "de"), ("m", 3, "fr")]
    judged = {r["page_num"]: r for r in lg.page_languages(pages.where("doc_id = 'm'"), lg.train(pages, labels)).collect()}
    assert [(s["lang"], s["n_sentences"]) for s in judged[0]["stretches"]] == [("en", 3), ("de", 2)]
    assert judged[1]["languages"] == ["en"] and 0.5 < judged[0]["confidence"] <= 1 and set(judged) == {0, 1, 2, 3, 6, 7}
    assert not judged[6]["running"] and judged[7]["running"]  # headings and lists have a language too


def test_nothing_to_learn_from(spark):
    pages, labels = tables(spark)
    none = labels.withColumn("lang_label", F.lit("und"))
    assert lg.relabelled(pages, none).count() == 0 and lg.relabelled(pages.limit(0), labels.limit(0)).count() == 0
    with pytest.raises(ValueError):
        lg.train(pages, none)
    assert lg.relabelled(pages.limit(0), labels).count() == 0


def test_prose():
    text = "# Head\n\nFirst line of a para-\ngraph with **words**. It ends. \"Quoted one here.\"\n\n- item of a list\n1. number one\n\n```\nsome code in here is not text\n\nat all\n```\nafter the code there is some.\n\n<table><tr><td>a b c d</td></tr></table>\n\nName Name\nStreet Lane 2\n\nSpis ...... 7 and so on\n\n![alt of it](x.webp)\n\nsee [the note](#n) of $x_1$ here"
    assert paragraphs(text) == ['First line of a paragraph with words. It ends. "Quoted one here."', "after the code there is some.", "see the note of here"]
    assert sentences("One is. Two are! \"Three?\" four") == ["One is.", "Two are!", "\"Three?\"", "four"] or len(sentences("One is. Two are! Three? four")) == 4
    assert is_full("This is one sentence.") and not is_full("This is no sentence") and not is_full("Too short.")
    assert paragraphs("") == [] and len(paragraphs("word and " * 200_000)) == 1


def test_languages_come_from_the_labels(spark):
    swedish = "Ingen visste om kartan verkligen kom från arkivet. På kuvertet står bara domen, annars är det tomt. Efter prövningen blev bara teckningen kvar."
    chinese = "没有人知道这张地图是不是真的来自档案馆 这封信放在桌子上 后来只剩下一幅画"
    rng, pages, labels, when = random.Random(2), [], [], datetime(2024, 1, 1)
    for k in range(150):
        lang = ("en", "de", "sv", "xx", "rare")[k % 5 if k % 5 < 4 or k < 10 else 0]
        text = " ".join(rng.sample(sentences(swedish), 3)) if lang in ("sv", "rare") else make(rng, lang if lang != "xx" else rng.choice(["en", "de"]), 3)
        pages.append(("d", k, text))
        labels.append(("d", k, lang, when))
    pages += [("n", 0, swedish), ("n", 1, make(rng, "de", 3)), ("n", 2, "# " + chinese), ("n", 3, "12 34")]
    labels += [("n", 0, "en", when)]
    df, named = spark.createDataFrame(pages, "doc_id string, page_num int, markdown string"), spark.createDataFrame(labels, "doc_id string, page_num int, lang_label string, labelled_at timestamp")
    known = lg.train(df, named)
    assert known.languages == ["de", "en", "sv"]  # pages called xx are in other languages, and rare is too rare to learn
    judged = {(r["doc_id"], r["page_num"]): r for r in lg.page_languages(df, known).collect()}
    assert judged[("n", 0)]["main_lang"] == "sv" and ("n", 2) in judged and ("n", 3) not in judged
    got = {tuple(r) for r in lg.relabelled(df, named, known).where("doc_id = 'n'").collect()}
    assert got == {("n", 0, "sv"), ("n", 1, "de")}


def test_confidence_is_fitted():
    rng = np.random.default_rng(1)
    gap = rng.integers(0, 100, 20_000) / 1000
    right = rng.random(20_000) < 1 / (1 + np.exp(-80 * gap))
    agreed = right & (rng.random(20_000) > 0.1)  # a tenth of the labels are wrong
    rows = pd.DataFrame({"gap": gap, "agreed": agreed.astype(int)}).value_counts().reset_index()
    a, b = lg.fitted_curve(rows["gap"].to_numpy(), rows["agreed"].to_numpy(), rows["count"].to_numpy(float))
    for x in (0.0, 0.02, 0.05):
        assert 1 / (1 + math.exp(-a * x - b)) == pytest.approx(1 / (1 + math.exp(-80 * x)), abs=0.06)


def test_long_repetition_and_scripts():
    codes, _ = lg._codes(["ab" * 10_000, "字" * 3, "жук"])
    assert codes.max() < 2048 and codes.min() == 0
    own, gram, rank = lg._ranked(["a " * 9000 + "b " * 8000 + "c " * 5000])
    assert [int(g) for g, r in sorted(zip(gram, rank), key=lambda x: x[1]) if g < 2048][:3] == [ord("a"), ord("b"), ord("c")]  # counts aren't cut
