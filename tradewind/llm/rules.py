"""Quality rules: counts of a text, and line labels by a linear-chain conditional random field.

Viterbi decoding marks each line of a text as content or boilerplate from features of the line and the labels of
its neighbours. A text is kept if lines of content hold at least CONTENT_SHARE of its word characters and the base
rules don't fail it. The field is fitted with numpy (forward-backward gradients) on a bounded sample of labelled
documents, whose label stands for all their lines.

Words are runs of anything but ASCII white space; lines are split at line feeds; lines without a word are no part
of the chain.

Defined cases: a null or empty text has no words, fails the base rules and isn't kept; equal scores of both labels
count as content, so an unfitted field (no labelled rows) keeps whatever passes the base rules; texts of any length
are read whole; repeated rows get equal results; columns of the documents, whatever their names, play no part, since
the result is an expression over the text alone.
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
from tradewind.llm.words import NOT_SPACE, windows, word_hashes, word_spans

CONTENT_SHARE = 0.5
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
PER_CLASS = 1500
#: Documents of more lines aren't drawn for fitting.
MOST_LINES = 400
EPOCHS = 8
RATE = 0.05
BOILERPLATE, CONTENT = 0, 1

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_CLASSES = {
    "symbol": b"#*$%&|<>",
    "pipe": b"|",
    "mark": b".,;:!?",
    "shout": b"!",
    "digit": b"0123456789",
    "upper": bytes(range(0x41, 0x5B)),
    "lower": bytes(range(0x61, 0x7B)),
}
_TABLES = np.zeros((len(_CLASSES), 256), dtype=bool)
for _i, _members in enumerate(_CLASSES.values()):
    _TABLES[_i, list(_members)] = True
N_FEATURES = len(_CLASSES) + 7

RESULT = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("content_share", T.DoubleType())]
    + [T.StructField("boilerplate_lines", T.ArrayType(T.IntegerType())), T.StructField("kept", T.BooleanType())]
)


class TextLines:
    """What the rules and the field need of a text: words, lines with a word, counts by line."""

    def __init__(self, text: bytes | None) -> None:
        self.raw = text or b""
        data = self.data = np.frombuffer(self.raw, dtype=np.uint8)
        self.starts, self.ends = word_spans(data, NOT_SPACE)
        self.hashes = word_hashes(data, self.starts, NOT_SPACE)
        breaks = np.flatnonzero(data == 0x0A)
        #: Line number of each word, then the lines that have one.
        line_of_word = np.searchsorted(breaks, self.starts)
        self.lines, self.first_word = np.unique(line_of_word, return_index=True)
        begins = np.append(0, breaks + 1)
        self.line_begin = begins[self.lines]
        self.line_end = np.append(breaks, len(data))[self.lines]

    def n_dup_lines(self) -> int:
        lines = [self.raw[a:b] for a, b in zip(self.line_begin.tolist(), self.line_end.tolist())]
        return len(lines) - len(set(lines))

    def in_repeated_windows(self) -> np.ndarray:
        """Whether each word stands in a window of three words that the text has twice or more."""
        inside = np.zeros(len(self.hashes), dtype=bool)
        if len(self.hashes) > 3:
            found = windows(self.hashes, 3)
            _, number, times = np.unique(found, return_inverse=True, return_counts=True)
            at = np.flatnonzero(times[number] > 1)
            for i in range(3):
                inside[at + i] = True
        return inside

    def chars(self) -> np.ndarray:
        """Code points of each word."""
        first = (self.data & 0xC0) != 0x80
        total = np.append(0, np.cumsum(first))
        return total[self.ends] - total[self.starts]

    def features(self, repeated: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """A row for each line with a word."""
        if not len(self.lines):
            return np.zeros((0, N_FEATURES))
        words = np.diff(np.append(self.first_word, len(self.starts)))
        size = np.add.reduceat(chars, self.first_word)
        counts = _TABLES[:, self.data]
        total = np.zeros((len(_CLASSES), len(self.data) + 1), dtype=np.int32)
        np.cumsum(counts, axis=1, out=total[:, 1:])
        shares = (total[:, self.line_end] - total[:, self.line_begin]) / size
        same = np.append(False, self.hashes[1:] == self.hashes[:-1])
        last = self.data[self.ends[np.append(self.first_word[1:], len(self.starts)) - 1] - 1]
        lines = [self.raw[a:b] for a, b in zip(self.line_begin.tolist(), self.line_end.tolist())]
        seen: dict[bytes, int] = {}
        for line in lines:
            seen[line] = seen.get(line, 0) + 1
        return np.column_stack(
            [
                np.ones(len(words)),
                shares.T,
                np.log1p(words) / 5,
                size / words / 10,
                np.add.reduceat(repeated.astype(np.float64), self.first_word) / words,
                np.add.reduceat(same.astype(np.float64), self.first_word) / words,
                (last == 0x2E).astype(np.float64),
                np.array([min(seen[line], 2) - 1 for line in lines], dtype=np.float64),
            ]
        )


@dataclass(frozen=True)
class LineField:
    """emission: features x labels; transition: label before x label after."""

    emission: np.ndarray
    transition: np.ndarray

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The likeliest labels of the lines (Viterbi); ties go to content."""
        if not len(features):
            return np.zeros(0, dtype=np.int64)
        scores = (features @ self.emission).tolist()
        (bb, bc), (cb, cc) = self.transition.tolist()
        b, c = scores[0]
        back = []
        for eb, ec in scores[1:]:
            from_b, from_c = (b + bb > c + cb), (b + bc > c + cc)
            back.append((BOILERPLATE if from_b else CONTENT, BOILERPLATE if from_c else CONTENT))
            b, c = (b + bb if from_b else c + cb) + eb, (b + bc if from_c else c + cc) + ec
        label = BOILERPLATE if b > c else CONTENT
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return np.array(labels[::-1])


NO_FIELD = LineField(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)))


def _marginals(scores: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: probabilities of each line's label, and summed ones of neighbouring labels."""
    n = len(scores)
    weights, steps = np.exp(scores - scores.max(axis=1, keepdims=True)), np.exp(transition)
    ahead, behind = np.empty((n, 2)), np.ones((n, 2))
    ahead[0] = weights[0] / weights[0].sum()
    for i in range(1, n):
        ahead[i] = (ahead[i - 1] @ steps) * weights[i]
        ahead[i] /= ahead[i].sum()
    for i in range(n - 2, -1, -1):
        behind[i] = steps @ (weights[i + 1] * behind[i + 1])
        behind[i] /= behind[i].sum()
    single = ahead * behind
    single /= single.sum(axis=1, keepdims=True)
    pairs = ahead[:-1, :, None] * steps[None] * (weights[1:] * behind[1:])[:, None, :]
    return single, (pairs / pairs.sum(axis=(1, 2), keepdims=True)).sum(axis=0) if n > 1 else np.zeros((2, 2))


def fit(sample: list[tuple[int, bytes]], seed: int = 1) -> LineField:
    """Gradient ascent of the likelihood of (label, packed features); a label holds for all lines of its text."""
    rows = [(label, np.frombuffer(packed, "<f4").reshape(-1, N_FEATURES).astype(np.float64)) for label, packed in sample]
    rows = [(label, x) for label, x in rows if len(x)]
    rng = np.random.default_rng(seed)
    emission, transition = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    for epoch in range(EPOCHS):
        for i in balanced_order(rng, [label for label, _ in rows]):
            label, x = rows[i]
            single, pairs = _marginals(x @ emission, transition)
            rate = RATE * (1 - epoch / EPOCHS) * 8 / (8 + len(x))
            want = np.zeros_like(single)
            want[:, label] = 1
            want_pairs = np.zeros((2, 2))
            want_pairs[label, label] = len(x) - 1
            emission += rate * (x.T @ (want - single) - 1e-3 * emission)
            transition += rate * (want_pairs - pairs - 1e-1 * transition)
    return LineField(emission, transition)


@F.arrow_udf(T.BinaryType())
def _packed_features(texts: pa.Array) -> pa.Array:
    packed = []
    for text in texts.cast(pa.binary()).to_pylist():
        lines = TextLines(text)
        many = len(lines.lines) > MOST_LINES
        packed.append(b"" if many else lines.features(lines.in_repeated_windows(), lines.chars()).astype("<f4").tobytes())
    return pa.array(packed, pa.binary())


def fit_on(docs: DataFrame, labels: DataFrame, usable: Column | None = None, per_class: int = PER_CLASS) -> LineField:
    """A field fitted on `per_class` documents of either labels.quality at most."""
    return fit(labelled_sample(docs, labels, "quality", _packed_features(F.col("text")), per_class, usable))


def judged(text: bytes | None, field: LineField) -> dict:
    """The fields of RESULT."""
    lines = TextLines(text)
    repeated, chars = lines.in_repeated_windows(), lines.chars()
    n_words, n_repeat = len(lines.starts), int(np.count_nonzero(repeated))
    failed = n_words < LEAST_WORDS or 100 * n_repeat > MOST_REPEATED_PERCENT * n_words
    marks = field.decode(lines.features(repeated, chars))
    share = 0.0
    if n_words:
        size = np.add.reduceat(chars, lines.first_word)
        share = float(size[marks == CONTENT].sum() / size.sum())
    return {
        "n_words": n_words,
        "word_chars": int(chars.sum()),
        "n_symbols": int(np.count_nonzero(_SYMBOLS[lines.data])),
        "n_dup_lines": lines.n_dup_lines(),
        "n_repeat_words": n_repeat,
        "base_failed": bool(failed),
        "content_share": share,
        "boilerplate_lines": lines.lines[marks == BOILERPLATE].tolist(),
        "kept": bool(not failed and share >= CONTENT_SHARE),
    }


def rules(field: LineField = NO_FIELD) -> Callable[[Column], Column]:
    """From a text column, a struct of RESULT; boilerplate_lines counts lines from 0."""
    arrow = pa.struct(
        [(n, pa.int64()) for n in RESULT.names[:5]]
        + [("base_failed", pa.bool_()), ("content_share", pa.float64())]
        + [("boilerplate_lines", pa.list_(pa.int32())), ("kept", pa.bool_())]
    )

    ship_package()

    @F.arrow_udf(RESULT)
    def judge(texts: pa.Array) -> pa.Array:
        return pa.array([judged(t, field) for t in texts.cast(pa.binary()).to_pylist()], arrow)

    return judge
