"""Text quality by positive-unlabelled learning.

Trusted positives are documents labelled good; everything else the model sees
is unlabelled web text, good and bad. The share of good text in it is estimated
first, from a classifier of positives against unlabelled text. Then a small
network minimises the non-negative unbiased risk of Kiryo et al. (2017): the
loss of the positives, plus what the unlabelled text costs as negatives less
what positives hidden in it would cost, never below zero.

A text is described by shares of kinds of characters and words, over the whole
of it, so that neither its language nor its vocabulary is a feature.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnsilver.llm.shared import held_out, text_of

MOST_POSITIVES = 4_000  # labelled good documents to fit on
MOST_UNLABELLED = 8_000  # unlabelled documents to fit on
HIDDEN = 16
STEPS = 1_500
LEAST_SCORE = 0.3  # of a document taken for good

KINDS = ("upper", "lower", "letter", "digit", "space", "mark", "symbol")
FEATURES = (*KINDS, "length", "mark_runs", "word_length", "repeated", "distinct", "line_length")


@lru_cache(1)
def _kind_of_point() -> np.ndarray:
    """The kind of every code point, by its general category."""
    first = {"Z": 4, "P": 5, "S": 6, "N": 3, "L": 2, "M": 2}
    exact = {"Lu": 0, "Ll": 1}
    kinds = np.full(0x110000, 6, np.uint8)
    for point in range(0x110000):
        category = unicodedata.category(chr(point))
        kinds[point] = exact.get(category, first.get(category[0], 6))
    kinds[9:14] = 4
    return kinds


def features(texts: Iterable[str]) -> np.ndarray:
    """One row for each text; an empty text has zeros."""
    kinds = _kind_of_point()
    rows = []
    for text in texts:
        if not text:
            rows.append([0.0] * len(FEATURES))
            continue
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = kinds[points]
        n = len(text)
        shares = np.bincount(kind, minlength=len(KINDS)) / n
        marks = kind >= 5
        words = text.split()
        count = max(1, len(words))
        rows.append([
            *shares.tolist(),
            float(np.log1p(n)),
            float(np.count_nonzero(marks[1:] & marks[:-1])) / n,
            (n - shares[4] * n) / count,
            sum(map(eq, words, words[1:])) / count,
            float(np.log(len(set(words)) + 1) / np.log(count + 2)),
            float(np.log1p(n / (text.count("\n") + 1))),
        ])
    return np.array(rows, dtype=float).reshape(len(rows), len(FEATURES))


@dataclass(frozen=True)
class Model:
    """The fitted network; ``prior`` is the estimated share of good text."""

    mean: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-_forward(self.weights, (rows - self.mean) / self.scale)[1]))


def _forward(weights: tuple[np.ndarray, ...], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = weights
    hidden = np.tanh(x @ w1 + b1)
    return hidden, np.clip(hidden @ w2 + b2, -30, 30)


def _backward(weights, x, hidden, slope) -> list[np.ndarray]:
    """Gradients for the slope of the loss at each row's output."""
    back = np.outer(slope, weights[2]) * (1 - hidden**2)
    return [x.T @ back, back.sum(0), hidden.T @ slope, np.atleast_1d(slope.sum())]


def _descend(slopes, positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, ...]:
    """Adam, full batch; ``slopes`` gives the loss slopes at the outputs of both sets."""
    chance = np.random.default_rng(5)
    width = positive.shape[1]
    weights = [
        chance.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN),
        chance.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1),
    ]
    both = np.vstack([positive, unlabelled])
    n = len(positive)
    first, second = [0 * w for w in weights], [0 * w for w in weights]
    for step in range(1, STEPS + 1):
        hidden, out = _forward(weights, both)
        slope = np.concatenate(slopes(out[:n], out[n:]))
        for i, gradient in enumerate(_backward(weights, both, hidden, slope)):
            gradient = gradient + 1e-4 * weights[i]
            first[i] = 0.9 * first[i] + 0.1 * gradient
            second[i] = 0.999 * second[i] + 0.001 * gradient**2
            moved = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
            weights[i] = weights[i] - 0.01 * moved
    return tuple(weights)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives in the unlabelled rows.

    Above any cut of a classifier's output, the unlabelled rows have at least
    the share of positives there times the prior; the least ratio bounds it.
    """

    def slopes(p: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (_sigmoid(p) - 1) / len(p), _sigmoid(u) / len(u)

    # Fit on one half, and look at the other.
    weights = _descend(slopes, positive[::2], unlabelled[::2])
    p = _forward(weights, positive[1::2])[1]
    u = _forward(weights, unlabelled[1::2])[1]
    if not len(p) or not len(u):
        return 0.5
    cuts = np.quantile(p, np.linspace(0.02, 0.7, 35))
    ratios = [(u >= cut).mean() / (p >= cut).mean() for cut in cuts]
    return float(np.clip(min(ratios), 0.05, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """The network of least non-negative risk. Without rows of both kinds, it says 0.5 to all."""
    width = len(FEATURES)
    if len(positive) < 2 or len(unlabelled) < 2:
        none = (np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(1))
        return Model(np.zeros(width), np.ones(width), none, 0.5)
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-6
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    prior = estimate_prior(p, u)

    def slopes(at_p: np.ndarray, at_u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Sigmoid loss: as a positive 1 - s, as a negative s.
        sp, su = _sigmoid(at_p), _sigmoid(at_u)
        dp, du = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
        if su.mean() - prior * sp.mean() >= 0:
            return -2 * prior * dp, du
        # The estimated risk of negatives fell below zero: step back from there.
        return prior * dp, -du

    return Model(mean, scale, _descend(slopes, p, u), prior)


def fit_on(docs: DataFrame, labels: DataFrame) -> Model:
    """A model of ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    Learns from rows that are not held out alone: at most ``MOST_POSITIVES``
    labelled 1, and at most ``MOST_UNLABELLED`` of all, whose labels are not
    looked at; both in the order of a hash of the id, which is as good as
    random and the same in every run.
    """

    def first(ids: DataFrame, most: int) -> DataFrame:
        order = F.xxhash64(F.lit("sample"), "doc_id")
        return ids.select("doc_id").filter("doc_id IS NOT NULL").orderBy(order, "doc_id").limit(most)

    good = labels.filter(F.col("quality") == 1).filter(~held_out("doc_id"))
    web = docs.filter(~held_out("doc_id"))
    chosen = (
        first(good, MOST_POSITIVES).distinct().withColumn("good", F.lit(True))
        .unionByName(first(web, MOST_UNLABELLED).distinct().withColumn("good", F.lit(False)))
    )
    # At most the two bounds together: small enough for every executor.
    texts = docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = _described(texts.select("doc_id", "good", "text"), "doc_id long, good boolean")
    found = rows.toPandas().sort_values(["doc_id", *FEATURES])
    x = found[list(FEATURES)].to_numpy(dtype=float).reshape(-1, len(FEATURES))
    is_good = found["good"].to_numpy(dtype=bool)
    return fit(x[is_good], x[~is_good])


def _described(texts: DataFrame, schema: str) -> DataFrame:
    """The columns before ``text``, and the features of it."""
    before = texts.columns[:-1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame(features(batch["text"]), columns=FEATURES)
            yield pd.concat([batch[before].reset_index(drop=True), found], axis=1)

    return texts.mapInPandas(run, f"{schema}, {', '.join(f'{name} double' for name in FEATURES)}")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score (0 to 1, higher: good text likelier), replacing a column of this name.

    The score hangs on the text alone; null counts as empty, and an empty text
    has the score of a text without any characters. Repeated rows stay.
    """

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(features(texts)), dtype=float)

    return docs.withColumn("score", scored(text_of("text")))
