"""Toxicity scores from a classifier that counterfactual pairs regularise.

A text is the set of its words and of their stems (first four and five
letters). A logistic model is fitted to labelled rows. For every labelled text
that names a group, a counterfactual copy names another group of the same kind;
the squared difference of the two scores is part of the loss, so the model
cannot lean on who is mentioned, and a neutral mention does not raise a score.

The fit uses a bounded sample of labelled rows (``SAMPLE_ROWS``); the scores
cover every row.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactum.llm.common import SLICE_CHARS, Memo, ragged_append, ragged_gather, store, text_slices

SAMPLE_ROWS = 12_000
FEATURES = 4_000
MIN_DOCS = 4
MIN_GAP = 1.5  # difference of the classes' log frequencies
THRESHOLD = 0.3
PENALTY = 4.0
PUNCTUATION = ".,;:!?\"'()[]{}<>*#$%&|-_/\\«»“”„…"

#: Terms that name groups, by kind. A counterfactual names the next of its kind.
IDENTITY_TERMS = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"], ["female", "male"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino", "african", "european"],
    ["gay", "straight", "lesbian", "bisexual", "heterosexual"],
    ["transgender", "cisgender"], ["immigrants", "natives", "refugees", "citizens"],
    ["disabled", "blind", "deaf"], ["old", "young"], ["poor", "rich"],
    ["frauen", "männer"], ["muslime", "christen", "juden"], ["ausländer", "einheimische"],
    ["femmes", "hommes"], ["musulmans", "chrétiens", "juifs"], ["immigrés", "citoyens"],
    ["mujeres", "hombres"], ["musulmanes", "cristianos", "judíos"], ["inmigrantes", "ciudadanos"],
]
_NEXT = {t: kind[(i + 1) % len(kind)] for kind in IDENTITY_TERMS for i, t in enumerate(kind)}


def normal(word: str) -> str:
    return word.lower().strip(PUNCTUATION)


def features(word: str) -> list[str]:
    """A normal word, and its stems where it is longer than they are."""
    if not word:
        return []
    return [word, *[f"{word[:n]}-" for n in (4, 5) if len(word) > n]]


def text_features(text: str) -> set[str]:
    words = {normal(w.decode()) for w in set(text.encode().split())}
    return set(chain.from_iterable(map(features, words)))


def names_group(text: str) -> bool:
    return any(normal(w.decode()) in _NEXT for w in set(text.encode().split()))


class _Columns:
    """Which of the given features the texts have; columns of words seen before are remembered."""

    def __init__(self, names: list[str], swap: bool = False):
        self.names, self.swap = {f: i for i, f in enumerate(names)}, swap
        self.memo = Memo(self._extend, self._clear)
        self._clear()

    def _clear(self):
        self.columns, self.offsets = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _extend(self, words: list[bytes]):
        plain = (normal(w.decode()) for w in words)
        if self.swap:
            plain = (_NEXT.get(w, w) for w in plain)
        found = [[self.names[f] for f in features(w) if f in self.names] for w in plain]
        ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)
        flat = np.fromiter(chain.from_iterable(found), np.int64, ends[-1])
        self.columns, self.offsets = ragged_append(self.columns, self.offsets, flat, ends)

    def pairs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, column), each pair once, in order; texts are read in slices of bounded size."""
        rows, cols, first = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last]) <= SLICE_CHARS):
                size += len(texts[last])
                last += 1
            split = [t.encode().split() for t in texts[first:last]]
            codes = self.memo.codes(list(chain.from_iterable(split)))
            row = np.repeat(np.arange(first, last), [len(w) for w in split])
            columns, sizes = ragged_gather(self.columns, self.offsets, codes)
            width = max(1, len(self.names))
            seen = np.unique(np.repeat(row, sizes) * width + columns)
            rows.append(seen // width)
            cols.append(seen % width)
            first = last
        return np.concatenate(rows), np.concatenate(cols)


@dataclass(frozen=True)
class Model:
    """Weights of the chosen features; a score is the logistic of their sum over a text."""

    weights: dict[str, float]
    bias: float


def choose(texts: list[str], labels: np.ndarray, limit: int = FEATURES) -> list[str]:
    """Features of enough toxic texts, by how far the classes differ in them; group names as well."""
    seen = Counter()
    for text, label in zip(texts, labels):
        if label:
            seen.update(text_features(text))
    identity = {f for t in _NEXT for f in features(t)}
    names = sorted({f for f, n in seen.items() if n >= MIN_DOCS} | identity)
    rows, cols = _Columns(names).pairs(texts)
    yes = np.bincount(cols[labels[rows] == 1], minlength=len(names))
    no = np.bincount(cols[labels[rows] == 0], minlength=len(names))
    total = np.bincount(labels, minlength=2) + 1.0
    gap = np.log((yes + 0.5) / total[1]) - np.log((no + 0.5) / total[0])
    weight = np.abs(gap) * np.sqrt(yes + no)
    best = [i for i in np.argsort(-weight, kind="stable") if abs(gap[i]) >= MIN_GAP][:limit]
    return sorted({names[i] for i in best} | {
        f for i, f in enumerate(names) if f in identity and yes[i] + no[i]})


def fit(texts: list[str], labels: list[int], penalty: float = PENALTY, ridge: float = 2e-5,
        rounds: int = 1000) -> Model:
    """Minimise log loss + ridge + penalty x mean squared score change under identity swaps.

    Accelerated gradient descent from zero, without randomness. With no
    labelled rows the score is 1/2 everywhere; with one class it is near it.
    """
    y = np.array(labels, np.int64)
    if not len(y):
        return Model({}, 0.0)
    names = choose(texts, y)
    k, n = len(names), len(y)
    rows, cols = _Columns(names).pairs(texts)
    paired = [t for t in texts if names_group(t)]
    own_rows, own_cols = _Columns(names).pairs(paired)
    cf_rows, cf_cols = _Columns(names, swap=True).pairs(paired)
    m = len(paired)

    w, b, vw, vb = np.zeros(k), 0.0, np.zeros(k), 0.0
    # A column's curvature is at most that of its rows with all their columns.
    size = np.bincount(rows, minlength=n) + 1.0
    curve = 0.25 * np.bincount(cols, size[rows], k) / n + 2 * ridge
    bias_curve = 0.25 * size.mean()
    if m:
        both = np.bincount(own_rows, minlength=m) + np.bincount(cf_rows, minlength=m)
        curve += 2 * penalty / m * (np.bincount(own_cols, both[own_rows], k)
                                    + np.bincount(cf_cols, both[cf_rows], k))
    for step in range(rounds):
        pull = step / (step + 3)
        w0, b0 = w + pull * vw, b + pull * vb
        z = np.bincount(rows, w0[cols], n) + b0
        miss = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        gw = np.bincount(cols, miss[rows], k) / n + 2 * ridge * w0
        gb = miss.mean()
        if m:
            change = np.bincount(own_rows, w0[own_cols], m) - np.bincount(cf_rows, w0[cf_cols], m)
            gw += 2 * penalty * (np.bincount(own_cols, change[own_rows], k)
                                 - np.bincount(cf_cols, change[cf_rows], k)) / m
        new_w, new_b = w0 - gw / curve, b0 - gb / bias_curve
        vw, vb, w, b = new_w - w, new_b - b, new_w, new_b
    return Model({f: float(v) for f, v in zip(names, w) if v}, float(b))


class _Scorer:
    def __init__(self, model: Model):
        self.columns = _Columns(list(model.weights))
        self.weights = np.array([*model.weights.values()], float)
        self.bias = model.bias

    def scores(self, texts: list[str]) -> np.ndarray:
        rows, cols = self.columns.pairs(texts)
        z = self.bias + np.bincount(rows, self.weights[cols], len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """(toxic, text) of at most ``limit`` labelled ids, chosen by a hash of the id.

    A doc_id labelled twice counts as toxic if any label says so; null labels
    are no labels. The chosen labels number at most ``limit``, so their
    broadcast is bounded and the texts are not shuffled.
    """
    chosen = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "doc_id", F.col("toxic").cast("int").alias("toxic"), F.coalesce("text", F.lit("")).alias("text"))


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> Model:
    """Fit a model in one task over the bounded sample; the driver gets the weights."""
    rows = store(training_rows(docs, labels, limit), "labelled").dropDuplicates(["doc_id"])

    def run(frames):
        import pandas as pd

        frames = list(frames)
        if not frames:
            return
        whole = pd.concat(frames).sort_values("doc_id")
        model = fit(whole["text"].tolist(), whole["toxic"].tolist())
        names = ["", *model.weights]
        yield pd.DataFrame({"name": names, "weight": [model.bias, *model.weights.values()]})

    found = rows.coalesce(1).mapInPandas(run, "name string, weight double").collect()
    weights = {r["name"]: r["weight"] for r in found}
    bias = weights.pop("", 0.0)
    return Model(dict(sorted(weights.items())), bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row; a null or empty text gets the score of no features."""

    def run(batches):
        scorer = _Scorer(model)
        for part, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(scorer.scores(texts), pa.float64())],
                names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: str = "doc_id"):
    """Rows never learnt from; a null id is not among them (it has no label either)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    Learns from the labels (doc_id, toxic) of rows that are not held out; reads
    no other column.
    """
    model = train(docs, labels.where(~held_out()), limit)
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
