"""Toxicity: a factorization machine over hashed terms.

A document is the set of its terms (lower-cased runs of letters and digits, as hashes). Its score is the logistic
of a bias, a weight for each term, and for each pair of terms the product of their factor vectors, which learns
pairs that mean more together than apart, such as an insult and a group's name. Pairs cost time linear in the
terms: half of the squared sum of the vectors less the sum of the squares. Weights and factors are fitted with
numpy by adaptive gradient descent on a bounded sample of labelled documents, first with shrinkage that drops terms of
no use, then without it. Terms of fewer than MIN_DOCS of its documents, terms about as frequent under either label, and
terms that the sample lacks count nothing.

Pair products are divided by the number of known terms of the text, since a text has far more pairs than terms.

Defined cases: a null, empty or wordless text scores the logistic of the bias; a text of any length is scored
whole; repeated rows get equal scores; without labelled rows every score is 0.5; columns of the documents,
whatever their names, play no part, since the score is an expression over the text alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.labelled import balanced_order, labelled_sample
from tradewind.llm.shared import ship_package
from tradewind.llm.words import ALPHANUMERIC, hashed_words

PER_CLASS = 2000
MIN_DOCS = 5
MAX_TERMS = 1 << 17
#: Standard errors by which a term's shares of toxic and of other documents must differ.
SCREEN = 3.0
FACTORS = 4
EPOCHS = 10
REFIT_EPOCHS = 40
RATE = 0.15
SHRINK = 0.2
THRESHOLD = 0.7


def terms(text: bytes | None) -> np.ndarray:
    """The distinct terms of a text as sorted hashes."""
    return np.unique(hashed_words(text, ALPHANUMERIC))


@F.arrow_udf(T.BinaryType())
def _packed_terms(texts: pa.Array) -> pa.Array:
    return pa.array([terms(t).astype("<u8").tobytes() for t in texts.cast(pa.binary()).to_pylist()], pa.binary())


@dataclass(frozen=True)
class FactorizationMachine:
    """known: sorted hashes of the terms; weights and factors in the same order."""

    bias: float
    known: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def score(self, text: bytes | None) -> float:
        z = self.bias
        if len(self.known):
            found = terms(text)
            at = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
            at = at[self.known[at] == found]
            if len(at):
                z += float(self.weights[at].sum(dtype=np.float64)) + _pairs(self.factors[at])
        return float(1.0 / (1.0 + np.exp(-z)))


def _pairs(v: np.ndarray) -> float:
    total = v.sum(axis=0, dtype=np.float64)
    return float((total @ total - np.einsum("ij,ij->", v, v, dtype=np.float64)) / (2 * len(v)))


def fit(sample: list[tuple[int, bytes]], seed: int = 1) -> FactorizationMachine:
    """Adaptive gradient descent over (label, packed terms): EPOCHS that shrink and select, REFIT_EPOCHS that refit."""
    rows = [(label, np.frombuffer(packed, "<u8").astype(np.uint64)) for label, packed in sample]
    if not rows:
        return FactorizationMachine(0.0, np.zeros(0, np.uint64), np.zeros(0, np.float32), np.zeros((0, FACTORS), np.float32))
    known, docs = np.unique(np.concatenate([t for _, t in rows]), return_counts=True)
    hits = np.concatenate([t for label, t in rows if label == 1] or [known[:0]])
    toxic = np.bincount(np.searchsorted(known, hits), minlength=len(known))
    n_toxic = sum(label for label, _ in rows)
    n_other, share = len(rows) - n_toxic, docs / len(rows)
    apart = toxic / max(n_toxic, 1) - (docs - toxic) / max(n_other, 1)
    error = np.sqrt(share * (1 - share) * (1 / max(n_toxic, 1) + 1 / max(n_other, 1))) + 1e-9
    enough = (docs >= MIN_DOCS) & (np.abs(apart) >= SCREEN * error)
    if enough.sum() > MAX_TERMS:
        enough &= docs > np.sort(docs)[-MAX_TERMS]
    known = known[enough]
    at = []
    for label, found in rows:
        at.append(np.flatnonzero(np.isin(known, found, assume_unique=True)))
    rng = np.random.default_rng(seed)
    bias, weights = 0.0, np.zeros(len(known), dtype=np.float32)
    factors = rng.normal(0, 0.01, (len(known), FACTORS)).astype(np.float32)
    steps_w, steps_v, steps_b = np.full(len(known), 1e-2, np.float32), np.full(factors.shape, 1e-2, np.float32), 1e-2
    for epoch in range(EPOCHS + REFIT_EPOCHS):
        if epoch == EPOCHS:  # steps start anew
            steps_w, steps_v, steps_b = np.full_like(steps_w, 1e-2), np.full_like(steps_v, 1e-2), 1e-2
        for i in balanced_order(rng, [label for label, _ in rows]):
            label, where = rows[i][0], at[i]
            v = factors[where]
            total = v.sum(axis=0)
            z = bias + float(weights[where].sum()) + (_pairs(v) if len(where) else 0.0)
            error = 1.0 / (1.0 + np.exp(-z)) - label
            steps_b += error * error
            bias -= RATE * error / np.sqrt(steps_b)
            if not len(where):
                continue
            steps_w[where] += error * error
            weights[where] -= RATE * error / np.sqrt(steps_w[where])
            slope = error * (total[None, :] - v) / len(where)
            steps_v[where] += slope * slope
            factors[where] -= RATE * 0.2 * slope / np.sqrt(steps_v[where])
        if epoch >= EPOCHS:
            continue
        # Soft threshold: a term must keep being of use. What falls to zero leaves the model.
        weights = (np.sign(weights) * np.maximum(np.abs(weights) - SHRINK, 0)).astype(np.float32)
        factors = (np.sign(factors) * np.maximum(np.abs(factors) - SHRINK * 0.02, 0)).astype(np.float32)
        used = (weights != 0) | factors.any(axis=1)
        renamed = np.cumsum(used) - 1
        at = [renamed[w[used[w]]] for w in at]
        known, weights, factors, steps_w, steps_v = known[used], weights[used], factors[used], steps_w[used], steps_v[used]
    return FactorizationMachine(bias, known, weights, factors)


def fit_on(docs: DataFrame, labels: DataFrame, usable: Column | None = None, per_class: int = PER_CLASS) -> FactorizationMachine:
    """A model of labels.toxic, fitted on `per_class` documents of either label at most."""
    return fit(labelled_sample(docs, labels, "toxic", _packed_terms(F.col("text")), per_class, usable))


def toxicity_score(model: FactorizationMachine) -> Callable[[Column], Column]:
    """From a text column, the probability of label 1, from 0 to 1."""

    ship_package()

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t) for t in texts.cast(pa.binary()).to_pylist()], pa.float64())

    return score
