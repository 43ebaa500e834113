"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors, one for each hashed word, each hashed character n-gram of its
words (white space bounds a word and counts as its edge) and each pair of equal neighbouring words, and an end
mark that every text has. A softmax over
two outputs gives the score. The vectors and outputs are fitted with numpy by stochastic gradient descent on a
bounded sample of labelled documents. As the outputs are linear in the mean, a fitted model scores with one
number for each bucket: the output difference of its vector.

Defined cases: a null or empty text has the end mark alone and gets its score; a text of any length is scored
whole; repeated rows get equal scores; without any labelled row every score is 0.5; columns of the documents,
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
from tradewind.llm.shared import each, given_back, ship_package

BUCKETS = 1 << 16  # the hashes below keep 16 bits
NGRAMS = (3, 4)
DIMENSIONS = 16
PER_CLASS = 2000
EPOCHS = 6
RATE = 0.5
THRESHOLD = 0.7

_SHIFT = np.uint32(16)
_SPREAD = np.uint32(0x9E3779B1)
_PLACE = np.uint32(0x85EBCA6B)
_END_MARK, _REPEAT = 0, 1


def subwords(text: str | None) -> np.ndarray:
    """Buckets of a text's words, pairs of equal neighbours and n-grams, with repeats, and of the end mark.

    All pairs of a word with itself share one bucket: a model learns repetition whatever the word.
    """
    end = np.array([_END_MARK], dtype=np.uint32)
    if not text:
        return end
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = (points == 0x20) | (points - np.uint32(9) <= 4)
    points = np.where(space, np.uint32(0x20), points)
    found = [end]
    for size in NGRAMS:
        count = len(points) - size + 1
        if count > 0:
            value = np.full(count, size, dtype=np.uint32)
            for i in range(size):
                value = (value + points[i : i + count]) * _SPREAD
                value ^= value >> np.uint32(15)
            for i in range(1, size - 1):
                value[space[i : i + count]] = 0
            value = (value * _SPREAD) >> _SHIFT
            found.append(value[value > _REPEAT])
    edges = np.diff(space.view(np.int8))
    starts, ends = np.flatnonzero(edges == -1) + 1, np.flatnonzero(edges == 1) + 1
    if len(starts):
        lengths = np.diff(np.append(starts, len(points)))
        place = np.arange(starts[0], len(points), dtype=np.uint32) - np.repeat(starts.astype(np.uint32), lengths)
        value = (points[starts[0] :] + place * _PLACE) * _SPREAD
        value = (value ^ (value >> np.uint32(15))) * _PLACE
        value[space[starts[0] :]] = 0
        word = np.add.reduceat(value, starts - starts[0], dtype=np.uint32)
        same = int(np.count_nonzero((word[1:] == word[:-1]) & (np.diff(ends - starts) == 0)))
        found.append(np.maximum((word * _SPREAD) >> _SHIFT, np.uint32(_REPEAT + 1)))
        found.append(np.full(same, _REPEAT, dtype=np.uint32))
    return np.concatenate(found)


@F.arrow_udf(T.BinaryType())
def _counted(texts: pa.Array) -> pa.Array:
    """Buckets of each text and their share, as packed numbers: bounded by the number of buckets."""
    packed = []
    for text in each(texts):
        buckets, counts = np.unique(subwords(text), return_counts=True)
        packed.append(buckets.astype("<u4").tobytes() + (counts / counts.sum()).astype("<f4").tobytes())
    return given_back(pa.array(packed, pa.binary()))


@dataclass(frozen=True)
class SubwordModel:
    """The output difference (label 1 less label 0) of each bucket's vector."""

    difference: np.ndarray

    def score(self, text: str | None) -> float:
        return float(1.0 / (1.0 + np.exp(-np.mean(self.difference[subwords(text)], dtype=np.float64))))


def fit(sample: list[tuple[int, bytes]], seed: int = 1) -> SubwordModel:
    """Stochastic gradient descent over (label, packed buckets and shares)."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    outputs = np.zeros((DIMENSIONS, 2), dtype=np.float32)
    rows = []
    for label, packed in sample:
        half = len(packed) // 2
        rows.append((label, np.frombuffer(packed[:half], "<u4").astype(np.int64), np.frombuffer(packed[half:], "<f4")))
    orders = [balanced_order(rng, [label for label, _, _ in rows]) for _ in range(EPOCHS)]
    steps, done = sum(map(len, orders)), 0
    for order in orders:
        for i in order:
            label, buckets, shares = rows[i]
            rate = RATE * (1 - done / steps)
            mean = shares @ vectors[buckets]
            z = mean @ outputs
            p = np.exp(z - z.max())
            error = -p / p.sum()
            error[label] += 1
            towards = outputs @ error
            outputs += rate * np.outer(mean, error)
            # A share is small in a long text: the step is taken relative to the largest share.
            vectors[buckets] += (rate / shares.max() * shares)[:, None] * towards[None, :] * min(1.0, 8 * shares.max())
            done += 1
    return SubwordModel((vectors @ (outputs[:, 1] - outputs[:, 0])).astype(np.float32))


def fit_on(docs: DataFrame, labels: DataFrame, usable: Column | None = None, per_class: int = PER_CLASS) -> SubwordModel:
    """A model of labels.quality, fitted on `per_class` documents of either label at most."""
    return fit(labelled_sample(docs, labels, "quality", _counted(F.col("text")), per_class, usable))


def quality_score(model: SubwordModel) -> Callable[[Column], Column]:
    """From a text column, the probability of label 1, from 0 to 1."""

    ship_package()

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        return given_back(pa.array([model.score(text) for text in each(texts)], pa.float64()))

    return score
