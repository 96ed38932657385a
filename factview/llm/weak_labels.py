"""Votes of several labelers aggregated by expectation-maximisation, and a span classifier trained on the result.

Works on patterns with their counts. The number of patterns is bounded by the
labelers (3 to their number) and the classes of the features, not by the data.
"""

from __future__ import annotations

import math

import numpy as np

Pattern = tuple[int, ...]


def posteriors(counts: dict[Pattern, float], steps: int = 50, prior: float = 0.5) -> dict[Pattern, float]:
    """The probability that a candidate with such votes (1 for, -1 against, 0 none) is real.

    Each labeler has a rate of voting for, among the votes it casts, for real
    and for false candidates. The rates start from trusting the votes and are
    re-estimated from the posteriors, with pseudo-counts; a vote not cast says
    nothing. Patterns are taken in order, so that equal counts give equal results.
    """
    if not counts:
        return {}
    patterns = sorted(counts)
    votes, held = np.array(patterns, dtype=float), np.array([counts[p] for p in patterns])
    yes, no = votes > 0, votes < 0
    rate = {1: np.full(votes.shape[1], 0.8), 0: np.full(votes.shape[1], 0.2)}
    real = prior
    for _ in range(steps):
        odds = math.log(real / (1 - real)) + yes @ np.log(rate[1] / rate[0]) + no @ np.log((1 - rate[1]) / (1 - rate[0]))
        out = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        real = min(0.95, max(0.05, (1 + held @ out) / (2 + held.sum())))
        for which, share in ((1, held * out), (0, held * (1 - out))):
            rate[which] = ((8 if which else 2) + share @ yes) / (10 + share @ (yes | no))
    return {p: float(x) for p, x in zip(patterns, out, strict=True)}


def classifier(examples: list[tuple[Pattern, float, float]], classes: list[int], steps: int = 400, pace: float = 2.0) -> list[list[float]]:
    """Weights for each class of each feature, of a logistic model of (classes, count, probability) by gradient descent.

    ``classes`` has the number of classes of each feature; the sum of the
    weights of a span's classes is its log-odds. No examples give zeros.
    """
    if not examples:
        return [[0.0] * n for n in classes]
    rows = sorted(examples)
    ends = np.cumsum([0, *classes])
    held = np.array([c for _, c, _ in rows]) / sum(c for _, c, _ in rows)
    real = np.array([r for _, _, r in rows])
    x = np.zeros((len(rows), ends[-1]))
    for k, (pattern, _, _) in enumerate(rows):
        x[k, ends[:-1] + np.array(pattern)] = 1
    weights = np.zeros(ends[-1])
    for _ in range(steps):
        guess = 1 / (1 + np.exp(-np.clip(x @ weights, -700, 700)))
        weights -= pace * (x.T @ (held * (guess - real)) + 1e-4 * weights)
    return [weights[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]
