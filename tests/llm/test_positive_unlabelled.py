import math
import zlib

import numpy as np
import pytest

from learnsilver.llm import positive_unlabelled as pu
from learnsilver.llm.queries import op9_positive_unlabelled
from learnsilver.llm.shared import read

FOLDER = "/root/testdata/sf0.1"


def test_the_prior_is_found():
    chance = np.random.default_rng(1)
    good, bad = (lambda n: chance.normal(0, 1, (n, 3))), (lambda n: chance.normal(4, 1, (n, 3)))
    for share in (0.4, 0.85):
        web = np.vstack([good(int(4000 * share)), bad(4000 - int(4000 * share))])
        chance.shuffle(web)
        assert abs(pu.estimate_prior(good(2000), web) - share) < 0.06


def test_features_hang_on_the_text_alone():
    rows = pu.features(["", "Some words here.", "SOME!! WORDS!! HERE!!", "x x x x", "a" * 200_000])
    named = [dict(zip(pu.FEATURES, row)) for row in rows]
    assert not rows[0].any() and np.isfinite(rows).all()
    assert named[2]["upper"] > 0.5 and named[2]["mark_runs"] > named[1]["mark_runs"]
    assert named[3]["repeated"] == 0.75


def test_held_out_labels_are_told(spark):
    found = op9_positive_unlabelled(spark, FOLDER).toPandas()
    docs = read(spark, FOLDER, "documents")
    assert len(found) == docs.count()
    assert found.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]
    assert found.score.between(0, 1).all()
    assert ((found.score >= 0.3) == (found.predicted == 1)).all()
    both = found.merge(read(spark, FOLDER, "labels").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert len(held) > 500
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert (good.predicted == 1).mean() > 0.97
    assert (bad.predicted == 0).mean() > 0.9


def test_the_model_is_the_same_in_every_run(spark):
    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    first, again = pu.fit_on(docs, labels), pu.fit_on(docs.repartition(5), labels.repartition(3))
    assert all(np.array_equal(a, b) for a, b in zip(first.weights, again.weights))
    assert first.prior == again.prior and 0.5 < first.prior <= 0.98


@pytest.mark.parametrize("rows", [[], [(1, "some text"), (1, "some text"), (2, None), (None, "")]])
def test_small_and_odd_tables(spark, documents, rows):
    docs = documents(rows)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    model = pu.fit_on(docs, labels.limit(len(rows)))
    found = pu.score(docs, model)
    assert found.columns == [*docs.columns, "score"]
    scores = [r.score for r in found.collect()]
    assert len(scores) == len(rows) and all(0 <= s <= 1 for s in scores)


def plain_output(weights, x):
    """The network, one row and one unit at a time."""
    w1, b1, w2, b2 = weights
    out = []
    for row in x:
        hidden = [math.tanh(sum(row[i] * w1[i, j] for i in range(len(row))) + b1[j]) for j in range(len(b1))]
        out.append(sum(h * w for h, w in zip(hidden, w2)) + float(b2[0]))
    return out


def plain_risk(weights, positive, unlabelled, prior):
    """The unbiased risk and its part for negatives, by their definition."""
    s = lambda z: 1 / (1 + math.exp(-z))
    p, u = plain_output(weights, positive), plain_output(weights, unlabelled)
    as_positive = prior * sum(1 - s(z) for z in p) / len(p)
    negatives = sum(s(z) for z in u) / len(u) - prior * sum(s(z) for z in p) / len(p)
    return as_positive + negatives, negatives


@pytest.mark.parametrize("prior", [0.2, 1.9])
def test_slopes_are_those_of_the_non_negative_risk(prior, monkeypatch):
    """One step of the fit against differences of the plain risk; with a large prior the negatives' part is below zero."""
    chance = np.random.default_rng(2)
    width = len(pu.FEATURES)
    positive, unlabelled = chance.normal(0.5, 1, (9, width)), chance.normal(0, 1, (14, width))
    seen = {}

    def descend(slopes, p, u):
        weights = [chance.normal(0, 0.3, (width, 4)), chance.normal(0, 0.3, 4), chance.normal(0.4, 0.3, 4), np.zeros(1)]
        hidden, out = pu._forward(weights, np.vstack([p, u]))
        slope = np.concatenate(slopes(out[: len(p)], out[len(p) :]))
        seen.update(weights=weights, p=p, u=u, gradients=pu._backward(weights, np.vstack([p, u]), hidden, slope))
        return tuple(weights)

    monkeypatch.setattr(pu, "estimate_prior", lambda p, u: prior)
    monkeypatch.setattr(pu, "_descend", descend)
    pu.fit(positive, unlabelled)
    weights, p, u = seen["weights"], seen["p"], seen["u"]
    _, negatives = plain_risk(weights, p, u, prior)
    assert (negatives < 0) == (prior > 1)

    def goal():
        whole, part = plain_risk(weights, p, u, prior)
        return whole if negatives >= 0 else -part

    for own, gradient in zip(weights, seen["gradients"]):
        for at in list(np.ndindex(own.shape))[:6]:
            middle = own[at]
            own[at] = middle + 1e-6
            above = goal()
            own[at] = middle - 1e-6
            below = goal()
            own[at] = middle
            assert (above - below) / 2e-6 == pytest.approx(np.asarray(gradient)[at], rel=1e-4, abs=1e-8)
