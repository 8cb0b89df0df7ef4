"""Problem 8: subject areas of each document.

A complement naive Bayes model over words is trained from the labelled documents, refined by expectation-maximization
over the paragraphs of all documents, and calibrated on labelled documents that took no part in training.

* Every document's running text is turned once into word buckets by paragraph, without pasted test items, and written
  to the shared folder; all later passes read that small table.
* Complement counts are smoothed towards the corpus's own word distribution, so that words that belong to no subject
  weigh nothing. Labels are cleaned first (case, spaces, unknown names), and only documents with a single subject
  train the model.
* In each expectation step every paragraph gets a posterior over subjects, with its document's mixture as the prior;
  the maximization step adds up the expected word counts of all paragraphs. Counts are added up in every partition
  before anything is shuffled, and their size is BUCKETS times the number of subjects. Steps end when the likelihood
  of the paragraphs rises by less than EM_TOLERANCE of itself.
* The scores' scale (naive Bayes is overconfident) and one logistic curve per subject are fitted on the held-out
  documents: the curve turns a subject's share of a document into the probability that the document is about it, for
  every subject on its own. Labels that are wrong even where a share leaves no doubt don't bend the curves. The
  probability decides which subjects a document has.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate, chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm import leakage
from quirework.llm.prose import paragraphs
from quirework.session import cut_lineage, written

BUCKETS = 1 << 17
#: Labelled documents that train the model, at most; chosen by a hash of their key.
TRAIN_DOCS = 40_000
#: One labelled document in so many is held out for calibration.
HOLD_OUT = 5
#: Rise of the likelihood, as a share of it, below which expectation-maximization has converged.
EM_TOLERANCE = 0.02
#: More subjects than this are refused: a model is BUCKETS times the subjects numbers, on the driver and in every task.
MAX_SUBJECTS = 200
MIXTURE_ROUNDS = 12
#: Words that the corpus's own distribution is worth in every complement.
SMOOTHING = 2000.0
#: Share of a word's uses in one subject from which on, and at which fully, the word counts.
CONCENTRATED = (0.35, 0.6)
#: A subject holds at least this share of a document's words.
SHARE = 0.2
#: Calibrated probability from which on a document is about a subject.
LIKELY = 0.5
#: Nats by which the best subject must beat the mean of all for a document to be about anything.
EVIDENCE = 2.0
_SCALES = (1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 12.0, 16.0)

FEATURES = "doc_id bigint, words array<int>, ends array<int>"


def _without_leaks(pages: list[list[list[str]]], block: leakage.Units) -> list[list[list[str]]]:
    """Words of every paragraph, without what is pasted from units of test items."""
    leaked: dict[int, list[int]] = {}
    for doc, unit, run, stretch, _ in leakage.scan((list(chain.from_iterable(page)) for page in pages), block, measured=False):
        if max(run, stretch) >= leakage.RUN_WORDS:
            leaked.setdefault(doc, []).append(unit)
    for doc, found in leaked.items():
        kept = []
        for words in pages[doc]:
            ids = np.fromiter(map(block.vocabulary.get, words, repeat(0)), np.int64, len(words))
            pasted = np.zeros(len(words), bool)
            if np.count_nonzero(ids) < leakage.SEED_WORDS:
                kept.append(words)
                continue
            for unit in found:
                for i, _, n in leakage.tiles(ids, block.ids[unit], leakage.SEED_WORDS - 1):
                    pasted[i : i + n] = True
            if pasted.any():
                # What lies between two pasted stretches close to each other is pasted too, with changes.
                at = np.flatnonzero(pasted)
                for a, b in zip(at[:-1], at[1:]):
                    if b - a <= 4:
                        pasted[a:b] = True
            kept.append([w for w, x in zip(words, pasted) if not x])
        pages[doc] = kept
    return pages


class _Buckets(dict):
    """Bucket of every word met so far."""

    def __missing__(self, word: str) -> int:
        self[word] = found = zlib.crc32(word.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)
        return found


def _paragraph_words(text: str | None) -> list[list[str]]:
    return [leakage.words_of(p) for p in paragraphs(text)] if text else []


def features(documents: DataFrame, items: DataFrame | None) -> DataFrame:
    """Word buckets of every document's running text by paragraph: doc_id, words, ends. Texts without any have no row.

    Test material that is small enough is sent to the workers; else documents are joined with what they give away.
    """
    texts = documents.select("doc_id", "text").where(F.length(F.trim("text")) > 0)
    shared = None
    if items is not None:
        units, _, few = leakage.material(items, ("passage", "question", "instruction"))
        if few:
            shared = documents.sparkSession.sparkContext.broadcast(leakage.sent(units))  # at most leakage.BLOCK_CHARS characters
        else:
            leaked = leakage.leaked_units(texts, units, few).select("doc_id", "unit_id").distinct()
            own = leaked.join(units, "unit_id").groupBy("doc_id").agg(F.collect_list("unit").alias("pasted"))  # what one document gives away
            texts = texts.join(own, "doc_id", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = _Buckets()
        for part in batches:
            rows = []
            pages = list(map(_paragraph_words, part["text"].tolist()))
            if shared is not None:
                pages = _without_leaks(pages, shared.value)
            elif "pasted" in part:
                pages = [page if own is None else _without_leaks([page], leakage.Units(list(own), list(own)))[0] for page, own in zip(pages, part["pasted"])]
            found = np.fromiter(map(buckets.__getitem__, chain.from_iterable(chain.from_iterable(pages))), np.int32)
            at = 0
            for doc, page in zip(part["doc_id"].tolist(), pages):
                ends = np.fromiter(accumulate(filter(None, map(len, page))), np.int32)
                if len(ends):
                    rows.append((doc, found[at : at + ends[-1]], ends))
                    at += int(ends[-1])
            if len(buckets) > 1_000_000:
                buckets.clear()
            yield pd.DataFrame(rows, columns=["doc_id", "words", "ends"])

    return written(texts.mapInPandas(run, FEATURES), "features")


def clean_labels(labels: DataFrame, subjects: DataFrame) -> DataFrame:
    """Subjects of each labelled document: doc_id, named (array); spellings are unified, unknown names dropped.

    The list of subjects is small; :func:`train` refuses more than MAX_SUBJECTS.
    """
    known = subjects.select(F.lower(F.trim("subject")).alias("subject")).distinct()
    bare = labels.select("doc_id", F.lower(F.trim("subject")).alias("subject")).where("subject is not null and doc_id is not null")
    return bare.join(F.broadcast(known), "subject", "left_semi").groupBy("doc_id").agg(F.sort_array(F.collect_set("subject")).alias("named"))


class Model:
    """Scores of words for subjects, the scale of scores, and a logistic curve per subject."""

    def __init__(self, subjects: list[str], counts: np.ndarray) -> None:
        self.subjects = subjects
        self.scale = 1.0
        self.curves = np.tile([12.0, -12.0 * SHARE], (len(subjects), 1))
        total = counts.sum(axis=1)
        background = (total + 0.01) / (total.sum() + 0.01 * len(total))
        complement = counts.sum(axis=1, keepdims=True) - counts + SMOOTHING * background[:, None]
        weight = np.log(complement / complement.sum(axis=0))
        # A word speaks for subjects as far as one of them holds most of its uses, sizes of subjects apart; the usual
        # words of a language lean to whatever its few labelled documents are about, and have no say.
        rate = (counts + 0.3 * background[:, None] * counts.sum(axis=0) / max(counts.sum(), 1)) / (counts.sum(axis=0) + 1)
        most = rate.max(axis=1) / (rate.sum(axis=1) + 1e-12)
        say = np.clip((most - CONCENTRATED[0]) / (CONCENTRATED[1] - CONCENTRATED[0]), 0, 1) * total / (total + 3.0)
        self.weight = ((weight.mean(axis=1, keepdims=True) - weight) * say[:, None]).astype(np.float32)

    def judge(self, batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores and posterior of every paragraph of a batch, and every document's shares of the subjects."""
        scores = np.add.reduceat(self.weight.take(batch.words, axis=0), batch.begins, axis=0).astype(np.float64)
        like = scores / self.scale
        like = np.exp(like - like.max(axis=1, keepdims=True))
        part = batch.size / np.add.reduceat(batch.size, batch.first)[batch.owner]
        theta = np.full((len(batch.first), scores.shape[1]), 1.0 / scores.shape[1])
        post = like
        for _ in range(MIXTURE_ROUNDS):
            post = like * theta[batch.owner]
            post /= post.sum(axis=1, keepdims=True)
            theta = np.add.reduceat(post * part[:, None], batch.first, axis=0) + 1e-6
            theta /= theta.sum(axis=1, keepdims=True)
        return scores, post, theta


class Batch:
    """Words of many documents in one array, with the paragraphs and documents they belong to."""

    def __init__(self, part: pd.DataFrame) -> None:
        words, ends = part["words"].tolist(), part["ends"].tolist()
        self.words = np.concatenate(words)
        count = np.array([len(e) for e in ends])
        self.owner = np.repeat(np.arange(len(count)), count)
        self.first = np.concatenate([[0], np.cumsum(count)[:-1]])
        flat = np.concatenate(ends).astype(np.int64)
        self.size = np.diff(flat, prepend=0)
        self.size[self.first] = flat[self.first]
        self.begins = np.concatenate([[0], np.cumsum(self.size)[:-1]])


def _batches(parts: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, Batch]]:
    for part in parts:
        for at in range(0, len(part), 2000):
            piece = part.iloc[at : at + 2000]
            yield piece, Batch(piece)


def _count(rows: DataFrame, run, n_subjects: int) -> tuple[np.ndarray, float]:
    """Sums of the sparse counts and of the likelihoods that ``run`` yields.

    At most BUCKETS times n_subjects numbers reach the driver.
    """
    summed = rows.mapInPandas(run, "cell int, n double").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    cell, n = summed["cell"].to_numpy(np.int64), summed["n"].to_numpy()
    out = np.zeros(BUCKETS * n_subjects)
    out[cell[cell >= 0]] = n[cell >= 0]
    return out.reshape(BUCKETS, n_subjects), float(n[cell < 0].sum())


def _cells(acc: np.ndarray, likelihood: float = 0.0) -> pd.DataFrame:
    """Counts by cell; the cell -1 holds the logarithm of the likelihood."""
    flat = acc.ravel()
    at = np.flatnonzero(flat > 1e-4)
    return pd.DataFrame({"cell": np.append(at, -1).astype(np.int32), "n": np.append(flat[at], likelihood)})


def train(feats: DataFrame, labels: DataFrame, subjects: DataFrame) -> Model:
    """Model from labels, refined over all documents of ``feats`` and calibrated.

    Raises ValueError without subjects, and if there are more than MAX_SUBJECTS.
    """
    spark = feats.sparkSession
    listed = subjects.select(F.lower(F.trim("subject")).alias("subject")).where("subject <> ''").distinct()
    names = sorted(r["subject"] for r in listed.limit(MAX_SUBJECTS + 1).collect())
    if not names:
        raise ValueError("there are no subjects")
    if len(names) > MAX_SUBJECTS:
        raise ValueError(f"there are more than {MAX_SUBJECTS} subjects")
    index = {s: k for k, s in enumerate(names)}
    known = clean_labels(labels, subjects)
    n_labelled = known.count()
    share = min(1.0, TRAIN_DOCS / max(n_labelled, 1))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))  # at most about TRAIN_DOCS rows
    labelled = cut_lineage(feats.join(F.broadcast(drawn), "doc_id").withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(HOLD_OUT)) == 0))

    def of_labels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = np.zeros((BUCKETS, len(index)))
        for part in batches:
            for words, named in zip(part["words"], part["named"]):
                np.add.at(acc, (words, index[named[0]]), 1)
        yield _cells(acc)

    base, _ = _count(labelled.where("not held and size(named) = 1"), of_labels, len(names))
    model = Model(names, base)
    model.scale = _fit_scale(labelled.where("held and size(named) = 1"), model, index)
    before = -np.inf
    while True:
        shared = spark.sparkContext.broadcast(model)  # BUCKETS x subjects numbers

        def expected(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            known_model = shared.value
            acc, total = np.zeros((BUCKETS, len(known_model.subjects)), order="F"), 0.0  # as expected_counts lays them out
            for _, batch in _batches(batches):
                scores, post, theta = known_model.judge(batch)
                acc += expected_counts(batch, post)
                total += likelihood(scores / known_model.scale, theta[batch.owner])
            yield _cells(acc, total)

        counts, now = _count(feats.select("words", "ends"), expected, len(names))
        if now <= before + EM_TOLERANCE * abs(before):
            break
        before, scale = now, model.scale
        model = Model(names, base + counts)
        model.scale = scale
    model.scale = _fit_scale(labelled.where("held and size(named) = 1"), model, index)
    model.curves = _fit_curves(labelled.where("held"), model)
    return model


def expected_counts(batch: Batch, post: np.ndarray) -> np.ndarray:
    """Expected word counts of every subject (BUCKETS rows), given the posteriors of the paragraphs."""
    words = batch.words.astype(np.intp)
    return np.stack([np.bincount(words, np.repeat(own, batch.size), minlength=BUCKETS) for own in post.T]).T


def likelihood(like: np.ndarray, prior: np.ndarray) -> float:
    """Logarithm of the likelihood of paragraphs with these scores, mixed as ``prior`` says."""
    top = like.max(axis=1, keepdims=True)
    return float((top[:, 0] + np.log((prior * np.exp(like - top)).sum(axis=1))).sum())


def _fit_scale(held: DataFrame, model: Model, index: dict[str, int]) -> float:
    """The scale of scores under which the held-out labels are likeliest."""
    shared = held.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        loss = np.zeros(len(_SCALES))
        for part, batch in _batches(batches):
            scores, _, _ = shared.value.judge(batch)
            right = np.array([index[named[0]] for named in part["named"]])[batch.owner]
            for k, scale in enumerate(_SCALES):
                s = scores / scale
                top = s.max(axis=1)
                loss[k] += np.minimum(top + np.log(np.exp(s - top[:, None]).sum(axis=1)) - s[np.arange(len(s)), right], 5.0).sum()
        yield pd.DataFrame({"k": range(len(_SCALES)), "loss": loss})

    losses = held.select("words", "ends", "named").mapInPandas(run, "k int, loss double").groupBy("k").agg(F.sum("loss").alias("loss")).collect()
    return _SCALES[min(losses, key=lambda r: (r["loss"], r["k"]))["k"]] if losses else 1.0


def _fit_curves(held: DataFrame, model: Model) -> np.ndarray:
    """Slope and offset, per subject, of the logistic curve from share to the probability of being named."""
    shared = held.sparkSession.sparkContext.broadcast(model)
    n, steps = len(model.subjects), 20

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((n, steps + 1, 2))
        for part, batch in _batches(batches):
            for theta, named in zip(shared.value.judge(batch)[2], part["named"]):
                yes = np.isin(shared.value.subjects, named).astype(int)
                table[np.arange(n), np.rint(theta * steps).astype(int), yes] += 1
        s, b, y = np.nonzero(table)
        yield pd.DataFrame({"s": s, "b": b, "y": y, "n": table[s, b, y]})

    rows = held.select("words", "ends", "named").mapInPandas(run, "s int, b int, y int, n double").groupBy("s", "b", "y").agg(F.sum("n").alias("n")).toPandas()
    return _curves(rows.assign(x=rows["b"] / steps), model.curves)


def _wrong_labels(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Part of the labels at the shares ``x``, which leave no doubt, that say ``y`` all the same; at most two fifths."""
    return min(0.4, (w[x & y].sum() + 0.5) / (w[x].sum() + 10.0))


def _curves(rows: pd.DataFrame, start: np.ndarray) -> np.ndarray:
    """Logistic curves through rows of subject (s), share (x), whether named (y) and count (n).

    One curve is fitted to all subjects, beginning at ``start``, and every subject's own is pulled to it, so that a
    subject with few held-out labels has the common curve.
    """
    x, y, w = rows["x"].to_numpy(), rows["y"].to_numpy(float), rows["n"].to_numpy(float)
    # What is named without a share, and not named with twice the share it takes, is wrongly labelled: the curve lies
    # between. One subject of several is left out more often than the only one.
    low = _wrong_labels(x < SHARE / 4, y == 1, w)
    mixed, whole = _wrong_labels((x >= 2 * SHARE) & (x < 0.9), y == 0, w), _wrong_labels(x >= 0.9, y == 0, w)
    span = 1 - low - np.where(x < 0.9, mixed, whole)
    common = _curve(x, y, w, low, span, start[0], (0.01, 0.01))
    curves = np.tile(common, (len(start), 1))
    for s in rows["s"].unique():
        own = (rows["s"] == s).to_numpy()
        curves[s] = _curve(x[own], y[own], w[own], low, span[own], common, (0.05, 1.0))
    return curves


def _curve(x: np.ndarray, y: np.ndarray, w: np.ndarray, low: float, span: np.ndarray, start: np.ndarray, pull: tuple[float, float]) -> np.ndarray:
    """Slope and offset of one curve, by scoring steps with a pull to the start."""
    at = np.array(start, float)
    basis = np.stack([x, np.ones_like(x)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ basis, -30, 30)))
        named = low + span * p
        slope = span * p * (1 - p)
        g = basis @ (w * (y - named) * slope / (named * (1 - named))) - pull * (at - start)
        h = (basis * (w * slope**2 / (named * (1 - named)))) @ basis.T + np.diag(pull)
        at += np.clip(np.linalg.solve(h, g), -5, 5)
    return at


SHARES_SCHEMA = "doc_id bigint, subject string, share double, probability double, n_words bigint"


def subject_shares(feats: DataFrame, model: Model) -> DataFrame:
    """Every subject that holds at least one word in twenty of a document: share of its words, calibrated probability.

    Documents without running text, or whose words speak for no subject, have no row.
    """
    shared = feats.sparkSession.sparkContext.broadcast(model)  # BUCKETS x subjects numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        a, b = known.curves.T
        for part, batch in _batches(batches):
            scores, _, theta = known.judge(batch)
            lead = np.maximum.reduceat(scores.max(axis=1) - scores.mean(axis=1), batch.first)
            doc, subject = np.nonzero((theta >= 0.05) & (lead >= EVIDENCE)[:, None])
            share = theta[doc, subject]
            yield pd.DataFrame(
                {
                    "doc_id": part["doc_id"].to_numpy()[doc], "subject": np.array(known.subjects, object)[subject], "share": share,
                    "probability": 1 / (1 + np.exp(-np.clip(a[subject] * share + b[subject], -30, 30))),
                    "n_words": np.add.reduceat(batch.size, batch.first)[doc],
                }
            )

    return feats.mapInPandas(run, SHARES_SCHEMA)


def document_subjects(documents: DataFrame, labels: DataFrame, subjects: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Subjects of every document with their shares and probabilities; pasted test items don't count.

    Without any subject, or any usable label, there are no rows. Null, empty and blank texts have none either.
    """
    if not subjects.where("trim(subject) <> ''").limit(1).count():
        return documents.sparkSession.createDataFrame([], SHARES_SCHEMA)
    feats = features(documents, items)
    return subject_shares(feats, train(feats, labels, subjects))


def decided(shares: DataFrame) -> DataFrame:
    """Rows of the subjects that the documents are about, by their calibrated probability."""
    return shares.where(F.col("probability") >= LIKELY)


def composition(shares: DataFrame) -> DataFrame:
    """Make-up of the corpus: documents and words of every subject."""
    return shares.groupBy("subject").agg(
        F.sum(F.when(F.col("probability") >= LIKELY, 1).otherwise(0)).alias("n_documents"), F.round(F.sum(F.col("share") * F.col("n_words"))).cast("bigint").alias("n_words")
    )
