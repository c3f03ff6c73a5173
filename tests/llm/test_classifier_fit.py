"""The ranking's fit against Newton's method on the same pairs, and its threshold and scores by plain loops."""

from __future__ import annotations

import math

import numpy as np
import pytest

from forkwise.llm import quality_classifier as Q


def loss(w, diff, decay):
    return float(np.mean(np.logaddexp(0, -(diff @ w))) + 0.5 * decay * w @ w)


def newton(diff, decay):
    """The minimum of the same convex loss, by second derivatives."""
    w = np.zeros(diff.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(diff @ w))
        grad = -(diff * p[:, None]).mean(0) + decay * w
        step = np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + decay * np.eye(len(w)), grad)
        size = 1.0
        while loss(w - size * step, diff, decay) > loss(w, diff, decay) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(grad).max() < 1e-10:
            break
    return w


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fit_reaches_the_minimum(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (300, Q.N_FEATURES))
    true = rng.normal(0, 0.6, Q.N_FEATURES)
    y = (x @ true + rng.logistic(0, 1, 300) > 0.4).astype(int)
    got = Q.fit(x, y)
    # All pairs of a preferred and another row, each once.
    z = np.clip((x - x.mean(0)) / np.maximum(x.std(0), 1e-3), -6, 6)
    every = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, z.shape[1])
    best = newton(every, 1e-3)
    assert loss(best, every, 1e-3) <= loss(got.weights, every, 1e-3) <= 1.05 * loss(best, every, 1e-3) + 0.01
    order = lambda w: np.mean(every @ w > 0)  # noqa: E731  pairs in the right order
    assert order(got.weights) >= order(best) - 0.01
    # The cut is the quantile of the rows that are not preferred, and a score of one half lies on it.
    strength = sorted(float(sum(a * b for a, b in zip(row, got.weights))) for row in z)
    k = int((y == 0).sum())
    assert math.isclose(got.cut, (strength[k - 1] + strength[k]) / 2, abs_tol=1e-9)
    assert sum(s >= 0.5 for s in got.scores(x)) == len(y) - k
    for row, score in zip(x[:20], got.scores(x[:20])):
        s = sum(min(6, max(-6, (a - m) / d)) * w for a, m, d, w in zip(row, got.mean, got.spread, got.weights)) - got.cut
        assert math.isclose(score, 1 / (1 + math.exp(-min(30, max(-30, s)))), rel_tol=1e-9)


def test_ties_at_the_cut_are_kept():
    """Rows as strong as the cut itself score one half and are predicted as preferred."""
    x = np.zeros((40, Q.N_FEATURES))
    x[:20, 0] = 1
    y = np.array([1] * 20 + [0] * 20)
    assert all(s >= 0.5 for s in Q.fit(x, y).scores(x)[:20]) and all(s < 0.5 for s in Q.fit(x, y).scores(x)[20:])
    same = np.zeros((10, Q.N_FEATURES))
    assert Q.fit(same, np.array([1, 0] * 5)).scores(same).tolist() == [0.5] * 10
