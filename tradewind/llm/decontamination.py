"""Benchmark decontamination by latent semantic retrieval.

Documents become words (lower-cased runs of letters and digits, hashed to 16 bits), which are written once. Passages are
PASSAGE words long and start every half of that. Terms are the words' low bits; a passage is the sum of the inverse
frequencies of its terms. A distributed randomised SVD of all passages gives the latent space: a random sketch goes once
through all passages (A'A times a random matrix), its orthonormal basis is rotated and scaled by the passages' moments
in it. Benchmark items, whole or, if long, in parts, are folded into that space. Each passage of each document is
compared with each item by cosine; for candidates that share words enough the longest common subsequence of words must cover MATCH of the
item within a run of little more than its length, and half of the words of the item's answer, its last sentence, must
be there.

The passes sum per task, then by lanes, then over lanes; what reaches the driver is as large as the number of terms times
that of dimensions. Items are the query set: they are searched in blocks of ITEMS_AT_ONCE, each broadcast.

Defined cases: null, empty and wordless texts and items match nothing; an item is searched whole, however long; equal
items match each; rows of a null id are searched and reported with that null, but stay in without_leaks; repeated rows are
reported each; empty tables give no rows; other columns, whatever their names, play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.shared import each, release_memory, ship_package, written
from tradewind.llm.words import ALPHANUMERIC, word_hashes, word_spans

PASSAGE = 32
TERMS = 1 << 13
DIMENSIONS = 64
OVERSAMPLED = 8
COSINE = 0.45
#: Of the weight of a part's words (of as many as the best passage must hold), so much must stand in a candidate.
SHARED = 0.5
MATCH = 0.7
ANSWER = 0.5
ITEM_PART = 48
ITEMS_AT_ONCE = 1024
LANES = 16
SLICES = 16
_HALF = PASSAGE // 2
_WORDS_AT_ONCE = 1 << 18

FOUND = "doc_id long, item_id long, coverage double, start_word long, end_word long"


def plain_words(text: str | None) -> np.ndarray:
    """Words of a text as 16-bit hashes."""
    if not text:
        return np.zeros(0, dtype=np.uint16)
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
    return (word_hashes(data, word_spans(data, ALPHANUMERIC)[0], ALPHANUMERIC) >> np.uint64(48)).astype(np.uint16)


def word_table(docs: DataFrame) -> DataFrame:
    """doc_id, words (packed little-endian 16-bit hashes) of the documents that have words."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [plain_words(t).astype("<u2").tobytes() or None for t in each(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(words, pa.binary())], ["doc_id", "words"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(emit, "doc_id long, words binary")
    return rows.where("words is not null")


class Chunk:
    """Words of some documents, their half passages, and which of these have their next in the same document."""

    def __init__(self, ids: list[int | None], texts: list[np.ndarray]) -> None:
        self.ids, self.texts = ids, texts
        self.words = np.concatenate(texts)
        self.terms = (self.words & np.uint16(TERMS - 1)).astype(np.int64)
        sizes = np.array([len(t) for t in texts])
        halves = -(-sizes // _HALF)
        self.doc = np.repeat(np.arange(len(texts)), halves)
        self.place = (np.arange(len(self.doc)) - np.repeat(np.cumsum(halves) - halves, halves)) * _HALF
        starts = np.repeat(np.cumsum(sizes) - sizes, halves) + self.place
        # A row for each half: its terms, then TERMS, for which every table of vectors gets a row of zeros.
        self.size = np.minimum(np.repeat(sizes, halves) - self.place, _HALF)
        self.rows = np.append(self.terms, np.full(_HALF, TERMS))[starts[:, None] + np.arange(_HALF)]
        self.rows[np.arange(_HALF) >= self.size[:, None]] = TERMS
        self.goes_on = np.append(self.doc[1:] == self.doc[:-1], False)

    def passages(self, vectors: np.ndarray) -> np.ndarray:
        """For each half passage the sum of the vectors of its words and of the next half's."""
        half = summed_rows(np.concatenate([vectors, np.zeros_like(vectors[:1])]), self.rows)
        out = half.copy()
        out[:-1][self.goes_on[:-1]] += half[1:][self.goes_on[:-1]]
        return out


def summed_rows(vectors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The sum of the vectors of each row of indices."""
    total = np.take(vectors, rows[:, 0], axis=0)
    for column in rows.T[1:]:
        total += np.take(vectors, column, axis=0)
    return total


def summed_by_term(terms: np.ndarray, vectors: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms, and for each the sum of vectors[of] where it stands. Occurrences are summed in rows of _HALF."""
    order = np.argsort(terms.astype(np.uint16), kind="stable")
    found, first, times = np.unique(terms[order], return_index=True, return_counts=True)
    rows_of = -(-times // _HALF)
    begin = np.repeat(first, rows_of) + (np.arange(rows_of.sum()) - np.repeat(np.cumsum(rows_of) - rows_of, rows_of)) * _HALF
    end = np.repeat(first + times, rows_of)
    at = begin[:, None] + np.arange(_HALF)
    which = np.append(of[order], np.full(_HALF, len(vectors)))[at]
    which[at >= end[:, None]] = len(vectors)
    sums = summed_rows(np.concatenate([vectors, np.zeros_like(vectors[:1])]), which)
    return found, np.add.reduceat(sums, np.cumsum(rows_of) - rows_of, axis=0)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, packed in zip(each(batch.column(0)), each(batch.column(1))):
            ids.append(doc_id)
            texts.append(np.frombuffer(packed, "<u2"))
            size += len(texts[-1])
            if size >= _WORDS_AT_ONCE:
                yield Chunk(ids, texts)
                ids, texts, size = [], [], 0
    if ids:
        yield Chunk(ids, texts)
    release_memory()


def _summed(partial: DataFrame, slices: int, shape: tuple[int, int]) -> np.ndarray:
    """Sum over tasks of (slice, lane, packed floats), by lanes first; `shape` is that of all slices together."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(b, "<f4") for b in rows["part"]], axis=0, dtype=np.float64).astype("<f4")
        return pd.DataFrame({"slice": [rows["slice"].iloc[0]], "lane": [rows["lane"].iloc[0]], "part": [total.tobytes()]})

    kind = "slice int, lane int, part binary"
    lanes = partial.groupBy("slice", "lane").applyInPandas(add, kind)
    rows = lanes.withColumn("lane", F.lit(0)).groupBy("slice", "lane").applyInPandas(add, kind).collect()
    out = np.zeros((slices, shape[0] * shape[1] // slices), dtype=np.float64)
    for r in rows:
        out[r["slice"]] = np.frombuffer(r["part"], "<f4")
    return out.reshape(shape)


def _parts(total: np.ndarray, slices: int) -> pa.RecordBatch:
    lane = TaskContext.get().partitionId() % LANES
    cut = total.astype("<f4").reshape(slices, -1)
    return pa.record_batch(
        [pa.array(range(slices), pa.int32()), pa.array([lane] * slices, pa.int32()), pa.array([c.tobytes() for c in cut], pa.binary())],
        ["slice", "lane", "part"],
    )


def inverse_frequencies(words: DataFrame) -> np.ndarray:
    """log(1 + all words / those of the term). A term seldom repeats within a passage, so occurrences count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TERMS, dtype=np.int64)
        for chunk in _chunks(batches):
            total += np.bincount(chunk.terms, minlength=TERMS)
        yield pa.record_batch([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], ["term", "n"])

    counts = np.zeros(TERMS)
    for row in words.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[row["term"]] = row["n"]
    return np.log1p(max(counts.sum(), 1) / np.maximum(counts, 1)).astype(np.float32)


def latent_space(words: DataFrame, weights: np.ndarray, seed: int = 1) -> np.ndarray:
    """TERMS x DIMENSIONS: maps the sum of a passage's rows to its place in the space of left singular vectors."""
    spark = words.sparkSession
    width = DIMENSIONS + OVERSAMPLED
    sketch = spark.sparkContext.broadcast(
        (np.random.default_rng(seed).standard_normal((TERMS, width)) * weights[:, None]).astype(np.float32)
    )

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((TERMS, width), dtype=np.float32)
        for chunk in _chunks(batches):
            y = chunk.passages(sketch.value)
            back = y.copy()
            back[1:][chunk.goes_on[:-1]] += y[:-1][chunk.goes_on[:-1]]
            found, sums = summed_by_term(chunk.terms, back, np.repeat(np.arange(len(back)), chunk.size))
            total[found] += sums
        yield _parts(total, SLICES)

    kind = "slice int, lane int, part binary"
    range_of = _summed(words.mapInArrow(through, kind), SLICES, (TERMS, width)) * weights[:, None]
    basis = np.linalg.qr(range_of)[0]
    turned = spark.sparkContext.broadcast((basis * weights[:, None]).astype(np.float32))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), dtype=np.float64)
        for chunk in _chunks(batches):
            y = chunk.passages(turned.value)
            total += y.T @ y
        yield _parts(total, 1)

    squares, axes = np.linalg.eigh(_summed(words.mapInArrow(moments, kind), 1, (width, width)))
    best = np.argsort(-squares)[:DIMENSIONS]
    sigma = np.sqrt(np.maximum(squares[best], 1e-12 * max(squares.max(), 1e-12)))
    return ((basis @ axes[:, best] / sigma) * weights[:, None]).astype(np.float32)


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence (bit-parallel)."""
    where: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        where[w] = where.get(w, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for w in b.tolist():
        m = where.get(w, 0)
        if m:
            v = ((v + (v & m)) | (v & ~m)) & full
    return len(a) - v.bit_count()


class Item:
    """A benchmark item: its words, the distinct ones of its answer, and the parts that are searched."""

    def __init__(self, item_id: int | None, text: str) -> None:
        self.item_id, self.words = item_id, plain_words(text)
        self.listed = self.words.tolist()
        sentences = [s for s in (plain_words(s) for s in re.split(r"[.?!\n]+", text)) if len(s)]
        self.answer = np.unique(sentences[-1]) if sentences else self.words
        n = len(self.words)
        begins = [0] if n <= ITEM_PART else [*range(0, n - ITEM_PART, ITEM_PART // 2), n - ITEM_PART]
        self.parts = [(b, self.words[b : b + ITEM_PART]) for b in begins] if n else []

    def verified(self, text: np.ndarray, near: int) -> tuple[float, int, int] | None:
        """Coverage and the run of the text around word `near` (where the item may begin) that has most of the item."""
        n = len(self.words)
        low, high = max(0, near - min(n, ITEM_PART)), min(len(text), near + PASSAGE + n)
        there = set(text[low:high].tolist())
        # As many words as the region has at all bound what it has in order.
        if sum(w in there for w in self.listed) < MATCH * n or common_words(self.words, text[low:high]) < MATCH * n:
            return None
        width = n + max(2, n // 4)
        best = (0, low)
        for begin in range(low, max(low, high - width) + 1, max(1, n // 8)):
            best = max(best, (common_words(self.words, text[begin : begin + width]), -begin))
        begin = abs(best[1])
        run = text[begin : begin + width]
        if best[0] < MATCH * n or np.isin(self.answer, run).mean() < ANSWER:
            return None
        return best[0] / n, begin, begin + len(run)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Columns of FOUND: a row for each document and each item whose wording it holds."""
    spark = docs.sparkSession
    ship_package(spark)
    words = written(word_table(docs), "words")
    weights = inverse_frequencies(words)
    idf = spark.sparkContext.broadcast(weights)
    space = spark.sparkContext.broadcast(latent_space(words, weights))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    blocks = -(-items.count() // ITEMS_AT_ONCE)
    found = spark.createDataFrame([], FOUND)
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        found = found.unionByName(_found(words, space, idf, [Item(r["item_id"], r["text"]) for r in rows]))
    return found


def _shared_weight(chunk: Chunk, passages: np.ndarray, parts: np.ndarray, holds: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weight of the words of each passage that stand in the part beside it."""
    weights = np.append(weights, np.float32(0))
    after = np.minimum(passages + 1, len(chunk.rows) - 1)
    first, second = chunk.rows[passages], chunk.rows[after]
    found = (holds[parts[:, None], first] * weights[first]).sum(axis=1)
    return found + (holds[parts[:, None], second] * weights[second]).sum(axis=1) * chunk.goes_on[passages]


def _found(words: DataFrame, space: Broadcast, idf: Broadcast, items: list[Item]) -> DataFrame:
    parts = [(i, begin, part) for i, item in enumerate(items) for begin, part in item.parts]
    queries = np.array([space.value[(p & np.uint16(TERMS - 1)).astype(np.int64)].sum(axis=0) for _, _, p in parts])
    queries = queries.reshape(-1, DIMENSIONS)
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-30)
    shared = words.sparkSession.sparkContext.broadcast((items, [(i, begin) for i, begin, _ in parts], queries.T.astype(np.float32)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, parts, queries = shared.value
        if not parts:
            return
        holds = np.zeros((len(parts), TERMS + 1), dtype=bool)
        needs = np.zeros(len(parts))
        for q, (i, begin) in enumerate(parts):
            words = items[i].words[begin : begin + ITEM_PART]
            holds[q, (words & np.uint16(TERMS - 1)).astype(np.int64)] = True
            weight = idf.value[(words & np.uint16(TERMS - 1)).astype(np.int64)].sum()
            needs[q] = SHARED * weight * min(1.0, (PASSAGE - _HALF // 2) / len(words))
        for chunk in _chunks(batches):
            y = chunk.passages(space.value)
            y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-30)
            cosines = y @ queries
            rows = np.flatnonzero(cosines.max(axis=1) >= COSINE)
            at, which = np.nonzero(cosines[rows] >= COSINE)
            at = rows[at]
            enough = _shared_weight(chunk, at, which, holds, idf.value) >= needs[which]
            at, which = at[enough], which[enough]
            best: dict[tuple[int, int], tuple[float, int, int]] = {}
            tried: set[tuple[int, int, int]] = set()
            for p, q in zip(at.tolist(), which.tolist()):
                doc, (i, offset) = int(chunk.doc[p]), parts[q]
                near = max(0, int(chunk.place[p]) - offset)
                if (doc, i, near) in tried or best.get((doc, i), (0.0,))[0] == 1.0:
                    continue
                tried.add((doc, i, near))
                hit = items[i].verified(chunk.texts[doc], near)
                if hit and hit > best.get((doc, i), (0.0, 0, 0)):
                    best[doc, i] = hit
            if best:
                columns = zip(*((chunk.ids[d], items[i].item_id, *hit) for (d, i), hit in best.items()))
                types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                names = ["doc_id", "item_id", "coverage", "start_word", "end_word"]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    return words.mapInArrow(search, FOUND)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that hold an item."""
    gone = leaks(docs, benchmark).where("doc_id is not null").select("doc_id").distinct()
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(docs.columns)
