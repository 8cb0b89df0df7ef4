from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirework.llm import subjects as sj

TOPICS = {"law": "court clause verdict statute notary appeal", "food": "oven yeast dough broth glaze pastry", "sport": "coach relay medal league penalty stadium"}
COMMON = "the of a note on page and it was kept in some old box by all who came later that year".split()


def paragraph(rng, topic):
    words = rng.choices(COMMON, k=22) + rng.choices(TOPICS[topic].split(), k=6)
    rng.shuffle(words)
    return " ".join(words) + "."


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(9)
    names, docs, labels, truth = list(TOPICS), [], [], {}
    for k in range(400):
        own = [names[k % 3]] * 4 if k % 5 else [names[k % 3]] * 2 + [names[(k + 1) % 3]] * 2
        docs.append((k, "# Head\n\n" + "\n\n".join(paragraph(rng, t) for t in own), "x"))
        truth[k] = set(own)
        if k % 3 == 0 or k % 7 == 0:
            label = rng.choice(names) if rng.random() < 0.05 else own[0]
            labels += [(k, f" {label.upper()} ", 0)] * 2
            if k % 5 == 0:
                labels.append((k, own[-1].title(), 0))
    docs += [(900, None, ""), (901, "", ""), (902, " \n", ""), (903, "Form 26\n\nName: ____", ""), (904, "It was kept in the box by all who came later.", "")]
    docs.append((905, docs[1][1] + "\n\n" + " ".join(f"unit{k} and word{k} of it" for k in range(12)), ""))
    labels += [(5, None, 0), (6, "unheard of", 0), (None, "law", 0), (99999, "law", 0)]
    areas = spark.createDataFrame([("Law", "t"), ("food", "t"), ("sport", "t"), (None, "t")], "subject string, title string")
    items = spark.createDataFrame([(1, " ".join(f"unit{k} and word{k} of it" for k in range(12)), None, None)], "item_id bigint, passage string, question string, instruction string")
    return spark.createDataFrame(docs, "doc_id bigint, text string, words string"), spark.createDataFrame(labels, "doc_id bigint, subject string, named int"), areas, items, truth


def test_held_out_accuracy(spark, tables):
    docs, labels, areas, items, truth = tables
    shares = sj.document_subjects(docs, labels, areas, items).where(F.col("share") >= sj.SHARE)
    got = {}
    for r in shares.collect():
        got.setdefault(r["doc_id"], set()).add(r["subject"])
    assert np.mean([got.get(k) == v for k, v in truth.items()]) > 0.97
    assert not {900, 901, 902, 903, 904} & set(got) and got[905] == got[1]
    probabilities = [r["probability"] for r in shares.collect()]
    assert 0.5 < np.median(probabilities) <= 1


def test_calibrated_probability_decides(spark, monkeypatch):
    rows = [(1, "a", 0.15, 0.8, 100), (1, "b", 0.3, 0.3, 100), (2, "a", 0.9, 0.99, 50)]
    shares = spark.createDataFrame(rows, sj.SHARES_SCHEMA)
    from quirework.llm import queries

    monkeypatch.setattr(queries, "_shares", lambda *_: shares)
    assert {tuple(r) for r in queries.p8_found(spark, "").collect()} == {(1, "a"), (2, "a")}
    assert {r["subject"]: r["n_documents"] for r in queries.p8_composition(spark, "").collect()} == {"a": 2, "b": 0}


def test_curves_follow_the_subject_and_not_wrong_labels():
    import pandas as pd

    def rows(s, limit, n):  # named from ``limit`` on, but for one label in eight
        out = []
        for k in range(21):
            x = k / 20
            yes = n * 7 // 8 if x >= limit else n // 80
            out += [(s, x, 1, yes), (s, x, 0, n - yes)]
        return out

    found = rows(0, 0.2, 400) + rows(1, 0.34, 400) + rows(2, 0.2, 400)
    start = np.tile([12.0, -12.0 * sj.SHARE], (4, 1))
    a, b = sj._curves(pd.DataFrame(found, columns=["s", "x", "y", "n"]), start).T
    at = -b / a
    assert at[0] == pytest.approx(0.175, abs=0.03) and at[1] == pytest.approx(0.325, abs=0.03)
    assert 0.15 < at[3] < 0.33  # without labels of its own: the common curve


def test_pasted_items_do_not_count(spark, tables):
    docs, _, _, items, _ = tables
    rows = {r["doc_id"]: r["words"] for r in sj.features(docs.where("doc_id in (1, 905)"), items).collect()}
    assert list(rows[905]) == list(rows[1])


def test_labels_are_cleaned(tables):
    _, labels, areas, _, _ = tables
    got = {r["doc_id"]: r["named"] for r in sj.clean_labels(labels, areas).collect()}
    assert 5 not in got and got[0] in (["law", "food"], ["food", "law"]) and None not in got


def test_edges(spark, tables):
    docs, labels, areas, items, _ = tables
    assert sj.document_subjects(docs, labels.limit(0), areas, items).count() == 0  # nothing learnt, nothing said
    assert sj.document_subjects(docs.limit(0), labels, areas, items.limit(0)).count() == 0
    assert sj.document_subjects(docs, labels, areas.limit(0), items).count() == 0
    with pytest.raises(ValueError):
        sj.train(sj.features(docs, None), labels, areas.limit(0))
    made = sj.composition(sj.document_subjects(docs, labels, areas)).collect()
    assert {r["subject"] for r in made} == set(TOPICS) and sum(r["n_documents"] for r in made) > 400


def test_mixture_of_one_document():
    model = sj.Model(["a", "b"], np.array([[90.0, 0.0], [0.0, 90.0], [50.0, 50.0]] + [[0.0, 0.0]] * (sj.BUCKETS - 3)))
    import pandas as pd

    batch = sj.Batch(pd.DataFrame({"words": [np.array([0, 0, 2, 1, 1, 2]), np.array([2, 2])], "ends": [np.array([3, 6]), np.array([2])]}))
    scores, post, theta = model.judge(batch)
    assert theta[0] == pytest.approx([0.5, 0.5], abs=0.05) and abs(scores[2]).max() < 0.05
    assert post[0, 0] > 0.7 and post[1, 1] > 0.7


def test_every_paragraph_counts_for_every_subject(tables, monkeypatch):
    docs, labels, areas, items, _ = tables
    undecided = docs.sparkSession.createDataFrame([(2000 + k, " ".join(COMMON), "") for k in range(300)], docs.schema)
    feats, made, count = sj.features(docs.unionByName(undecided), items), [], sj._count
    monkeypatch.setattr(sj, "_count", lambda *args: made.append(count(*args)) or made[-1])
    sj.train(feats, labels, areas)
    n_words = sum(len(r["words"]) for r in feats.collect())
    assert made[1][0].sum() == pytest.approx(n_words, rel=1e-3)  # undecided and mixed paragraphs too
    rounds = [likely for _, likely in made[1:]]
    assert len(rounds) >= 2 and rounds[-1] <= rounds[-2] + sj.EM_TOLERANCE * abs(rounds[-2])  # until it hardly rises
    assert all(b > a + sj.EM_TOLERANCE * abs(a) for a, b in zip(rounds[:-2], rounds[1:-1]))


def test_more_test_material_than_is_sent_and_too_many_subjects(spark, tables, monkeypatch):
    docs, labels, _, items, _ = tables
    some = docs.where("doc_id in (1, 2, 905)")
    sent = {r["doc_id"]: (r["words"], r["ends"]) for r in sj.features(some, items).collect()}
    monkeypatch.setattr(sj.leakage, "BLOCK_CHARS", 10)
    assert {r["doc_id"]: (r["words"], r["ends"]) for r in sj.features(some, items).collect()} == sent
    many = spark.createDataFrame([(f"s{k}",) for k in range(sj.MAX_SUBJECTS + 1)], "subject string")
    with pytest.raises(ValueError, match="more than"):
        sj.document_subjects(some, labels, many, items)
