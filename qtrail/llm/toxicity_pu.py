"""Toxicity: non-negative positive-unlabelled learning.

Method. A linear classifier on hashed text features is trained in numpy from
confirmed toxic examples and unlabelled text only. With class prior p, loss l
and mean risks over the two sets, the risk is
p * R(positive as toxic) + max(0, R(unlabelled as clean) - p * R(positive as
clean)); where the second part turns negative, its gradient is reversed
(weighted by ``GAMMA``), which keeps a flexible model from fitting the
unlabelled set. The prior is the toxic share among the training labels.
Features are those that the confirmed examples have far oftener than the
unlabelled texts do.

Scale. Both sets are bounded samples (``positive_rows``, ``unlabelled_rows``:
the ids of the smallest hashes); scoring is one Arrow map over whole texts.

Defined results: a null text is empty and gets a score like any other; label
rows of one document that differ count as toxic; without confirmed examples
every score is 0; repeated rows give repeated results; an empty table gives an
empty result. Ids, sources and languages are never features.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qtrail.llm.features import Adam, Ragged, Rows, document_counts, labelled_sample, score_texts, sigmoid, width

POSITIVE_ROWS = 6_000
UNLABELLED_ROWS = 20_000
HELD_OUT_FOLDS = 5
LEAST_EXAMPLES = 5  # confirmed examples that a feature needs
LEAST_Z = 4.0  # standard deviations above the unlabelled rate
STEPS = 300
RATE = 0.05
RIDGE = 2e-5
GAMMA = 1.0


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def score(self, rows: list[np.ndarray]) -> dict[str, np.ndarray]:
        return {"score": sigmoid(np.array([self.weights[r].sum() for r in rows]) + self.bias)}

    def scorer(self) -> Callable[[list[np.ndarray]], dict[str, np.ndarray]]:
        return self.score


def fold(key: str = "doc_id", folds: int = HELD_OUT_FOLDS) -> Column:
    """crc32 of the id's text modulo ``folds``; 0 is held out."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def telling_features(positive: Ragged | list[np.ndarray], unlabelled: Ragged | list[np.ndarray]) -> np.ndarray:
    seen = document_counts(positive, width())
    expected = document_counts(unlabelled, width()) * (len(positive) / max(1, len(unlabelled)))
    least = min(LEAST_EXAMPLES, max(1, len(positive) // 4))
    return np.flatnonzero((seen >= least) & (seen - expected > LEAST_Z * np.sqrt(expected + 1)))


def fit(positive: Ragged | list[np.ndarray], unlabelled: Ragged | list[np.ndarray], prior: float, steps: int = STEPS) -> ToxicityModel:
    weights = np.zeros(width())
    if not len(positive) or not len(unlabelled) or prior <= 0:
        return ToxicityModel(weights, -1e3)
    chosen = telling_features(positive, unlabelled)
    p, u, m = Rows(positive, chosen), Rows(unlabelled, chosen), chosen.size
    x = np.zeros(m + 1)
    x[m] = np.log(prior / (1 - prior)) if prior < 1 else 0.0
    adam = Adam(x.size, RATE)
    for _ in range(steps):
        fp, fu = p.dot(x[:m]) + x[m], u.dot(x[:m]) + x[m]
        clean_risk = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        as_toxic, as_clean = -prior * sigmoid(-fp) / p.n, prior * sigmoid(fp) / p.n
        if clean_risk >= 0:
            dp, du = as_toxic - as_clean, sigmoid(fu) / u.n
        else:
            dp, du = GAMMA * as_clean, -GAMMA * sigmoid(fu) / u.n
        x = adam.step(x, np.concatenate([p.back(dp) + u.back(du) + RIDGE * x[:m], [dp.sum() + du.sum()]]))
    weights[chosen] = x[:m]
    return ToxicityModel(weights, float(x[m]))


def train(docs: DataFrame, labels: DataFrame, positive_rows: int = POSITIVE_ROWS,
          unlabelled_rows: int = UNLABELLED_ROWS) -> ToxicityModel:
    """``labels``: ``doc_id`` and ``toxic``; held-out rows teach nothing."""
    usable = (labels.where(F.col("toxic").isNotNull() & (fold() != 0)).groupBy("doc_id")
              .agg(F.max("toxic").cast("int").alias("toxic")))
    share = usable.agg(F.avg("toxic")).first()[0]
    if not share:
        return fit([], [], 0.0)
    positive, _ = labelled_sample(docs, usable.where("toxic = 1"), positive_rows)
    ids = docs.where(F.col("doc_id").isNotNull() & (fold() != 0)).select("doc_id", F.lit(0).alias("none")).distinct()
    unlabelled, _ = labelled_sample(docs, ids, unlabelled_rows)
    return fit(positive, unlabelled, float(share))


def score_documents(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``row`` and ``score`` of every document."""
    return score_texts(docs, model.scorer(), ["score"], text)
