"""Toxicity: the scorer against a plain sum over distinct words, the fit against its likelihood."""

import math

import numpy as np
import pandas as pd
import pytest

from pricelab.llm import toxicity as T


def test_scorer_equals_plain_sum(spark):
    rng = np.random.default_rng(0)
    words = ["vile", "vileness", "VILE", "vile,", "kind", "kindly", "(vile)", "un-kind", "x1y", "ünfein", "ünfeiner", "", "a"]
    weights = {f: float(rng.normal()) for w in ("vile", "vileness", "kindly", "ünfeiner", "un") for f in T.word_features(w)}
    model = T.OrdinalModel(weights, (0.5, 1.25))
    texts = [None, "", "   "] + [" ".join(rng.choice(words, int(rng.integers(1, 30)))) for _ in range(60)] + ["vile " * 50_000]
    got = T.scorer(model).func(pd.Series(texts))
    for text, r in zip(texts, got.itertuples()):
        s = sum(weights.get(f, 0.0) for w in T.document_words(text) for f in T.word_features(w))
        below = [1 / (1 + math.exp(-(t - s))) for t in model.thresholds]
        assert (r.p_clean, r.p_toxic, r.p_severe) == pytest.approx((below[0], below[1] - below[0], 1 - below[1]), abs=1e-12)
        assert r.severity == pytest.approx(r.p_toxic + 2 * r.p_severe) and r.toxic == (below[0] < 0.5)


def loss(w, thresholds, x, y, weight, l2=1e-3):
    s = x @ w
    below = [1 / (1 + np.exp(-(t - s))) for t in thresholds]
    p = np.choose(y, [below[0], below[1] - below[0], 1 - below[1]])
    return -(weight / weight.sum() * np.log(p)).sum() + l2 / 2 * (w ** 2).sum()


def test_fit_is_near_the_optimum_and_weights_are_copies():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 4))
    y = np.digitize(x @ [1.5, -1.0, 0.5, 0.0] + rng.logistic(size=400), [0.5, 2.0])
    weight = rng.integers(1, 4, 400).astype(float)
    w, thresholds = T.fit_ordinal(x, y, weight)
    best = loss(w, thresholds, x, y, weight)
    for _ in range(200):            # no nearby model is better by more than the steps' tolerance
        step = rng.normal(size=6) * 0.05
        t = np.array(thresholds) + step[4:]
        if t[0] < t[1]:
            assert loss(w + step[:4], t, x, y, weight) > best - 1e-4
    copies = np.repeat(np.arange(400), weight.astype(int))
    w2, t2 = T.fit_ordinal(x[copies], y[copies])
    assert np.allclose(w, w2, atol=1e-6) and np.allclose(thresholds, t2, atol=1e-6) and thresholds[0] < thresholds[1]
