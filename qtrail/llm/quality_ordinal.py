"""Quality classifier: ordinal regression on graded ratings.

Method. A cumulative-link (proportional-odds) model: one weight per hashed
text feature, shared by all grades, and ordered thresholds, so
P(grade <= k) = sigmoid(threshold_k - weights . features). It is fitted in
numpy on the driver by maximum likelihood, on a bounded sample of ratings
(``sample_rows``, the ids of the smallest hashes). Scoring is one Arrow map
over whole texts, without a shuffle; the model is a vector of fixed width.

The score gives the expected grade and the tail probability
P(grade >= ``tail_grade``), by which documents are selected.

Defined results: a null text is empty and gets a score like any other; ratings
of one document that differ count by the lowest; null ratings are left out;
with no ratings at all, or one grade only, every document keeps the observed
grade (0 without ratings) and a tail probability of 1; repeated rows give
repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qtrail.llm.features import Adam, Ragged, Rows, document_counts, labelled_sample, score_texts, sigmoid, width

SAMPLE_ROWS = 12_000
LEAST_DOCS = 5
STEPS = 120
RATE = 0.05
RIDGE = 1e-4


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray  # by feature number
    thresholds: np.ndarray  # ascending, one less than there are grades
    grades: np.ndarray  # ascending values

    def at_most(self, rows: list[np.ndarray]) -> np.ndarray:
        """P(grade <= k) for every row and every grade."""
        f = np.array([self.weights[r].sum() for r in rows])
        return np.concatenate([sigmoid(self.thresholds[None, :] - f[:, None]), np.ones((f.size, 1))], 1)

    def scorer(self, tail_grade: float) -> Callable[[list[np.ndarray]], dict[str, np.ndarray]]:
        below = int(np.searchsorted(self.grades, tail_grade))  # grades under the tail

        def score(rows: list[np.ndarray]) -> dict[str, np.ndarray]:
            cumulative = self.at_most(rows) if rows else np.empty((0, self.grades.size))
            share = np.diff(np.concatenate([np.zeros((len(rows), 1)), cumulative], 1), axis=1)
            one = self.grades.size == 1
            tail = 1 - cumulative[:, below - 1] if below and not one else np.ones(len(rows))
            return {"expected_grade": share @ self.grades, "tail_probability": tail}

        return score


def fit(rows: Ragged | list[np.ndarray], grades: np.ndarray, steps: int = STEPS) -> OrdinalModel:
    values = np.unique(grades) if grades.size else np.zeros(1)
    weights = np.zeros(width())
    if values.size < 2:
        return OrdinalModel(weights, np.empty(0), values.astype(np.float64))
    level = np.searchsorted(values, grades)
    chosen = np.flatnonzero(document_counts(rows, width()) >= min(LEAST_DOCS, max(1, len(rows) // 20)))
    data, n, k = Rows(rows, chosen), len(rows), values.size
    share = np.clip(np.cumsum(np.bincount(level, minlength=k))[:-1] / n, 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    # Thresholds as a first value and the logarithms of the gaps: always ordered.
    x = np.concatenate([np.zeros(chosen.size), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    adam, m = Adam(x.size, RATE), chosen.size
    for _ in range(steps):
        gaps = np.exp(x[m + 1:])
        edge = np.concatenate([[-np.inf], x[m] + np.concatenate([[0], np.cumsum(gaps)]), [np.inf]])
        f = data.dot(x[:m])
        upper, lower = sigmoid(edge[level + 1] - f), sigmoid(edge[level] - f)
        p = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / p, lower * (1 - lower) / p
        # d(-log likelihood) of each inner edge, then of its parameters.
        at_edge = (np.bincount(level, low, k)[1:] - np.bincount(level, up, k)[:-1]) / n
        tails = np.cumsum(at_edge[::-1])[::-1]
        gradient = np.concatenate([data.back((up - low) / n) + RIDGE * x[:m], tails[:1], tails[1:] * gaps])
        x = adam.step(x, gradient)
    weights[chosen] = x[:m]
    return OrdinalModel(weights, x[m] + np.concatenate([[0], np.cumsum(np.exp(x[m + 1:]))]), values.astype(np.float64))


def train(docs: DataFrame, ratings: DataFrame, sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """``ratings``: ``doc_id`` and a numeric ``grade``."""
    one = (ratings.where(F.col("grade").isNotNull()).groupBy("doc_id")
           .agg(F.min("grade").cast("double").alias("grade")))
    rows, labels = labelled_sample(docs, one, sample_rows)
    return fit(rows, np.array([g for g, in labels], dtype=np.float64))


def grade_documents(docs: DataFrame, model: OrdinalModel, tail_grade: float = 1, text: str = "text") -> DataFrame:
    """``row``, ``expected_grade``, ``tail_probability`` of every document."""
    return score_texts(docs, model.scorer(tail_grade), ["expected_grade", "tail_probability"], text)
