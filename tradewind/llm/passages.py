"""Substring dedup by collinear chaining.

Seeds are hashed runs of SEED words, picked as the least of each WINDOW of neighbouring runs, so that any run of
SEED + WINDOW - 1 words that two texts share gives both a common seed. A seed that a text has again is matched with the
same occurrence in the owner, or with its first where the owner has fewer. A seed's owner is the least doc_id that has it; every other text's seed is matched with its owner, and with those of
the seeds beside it if they have it too: three matches at most, so matches grow with the texts and not with the
pairs of a group. The matches of two documents are chained in order with a
gap cost, each to the best of the matches within reach, which Fenwick trees give, chains are aligned word by word between their matches and beyond
their ends, and those of IDENTITY and more become spans; a chain of less is parted at its widest gap. A text's spans are joined where PART_GAP words or fewer lie between; a passage is a span of
LEAST words. The owner's place counts as the first; the passage is repeated in the other document.

Defined cases: null, empty and short texts have no passages; rows of a null doc_id take no part (and stay whole);
rows that repeat an id don't repeat each other; exact copies repeat from end to end; ties of seeds go to the least
position; an empty table gives no rows; texts of any length are read whole; other columns, whatever their
names, play no part and are kept by without_repeats, which sets n_chars, where it is there, to the new length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.shared import each, given_back, release_memory, ship_package, written
from tradewind.llm.words import NOT_SPACE, hashed_words, occurrences, windows, word_spans

SEED = 8
WINDOW = 14
IDENTITY = 0.8
LEAST = 50
#: Most words between two parts of a passage: neighbouring seeds lie at most WINDOW apart.
PART_GAP = WINDOW - SEED
GAP_COST = 0.1
MOST_GAP = 40
#: Most words from a match to the next of its chain.
REACH = SEED + MOST_GAP
BLOCK = 64
MARGIN = 40
DROP = 6

_NOTHING = (float("-inf"), -1)
_SEEDS = "seed long, doc_id long, place int, nth int"
_CHAINS = "owner long, doc_id long, owner_places array<int>, places array<int>"


def seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds and their places; none for fewer than SEED words."""
    if len(words) < SEED:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    runs = windows(words, SEED)
    if len(runs) <= WINDOW:
        at = np.array([int(np.argmin(runs))])
    else:
        # Running minimum of windows by doubling; then the first place of it in each window.
        n = len(runs) - WINDOW + 1
        least, width = runs.copy(), 1
        while width * 2 <= WINDOW:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:n], least[WINDOW - width : WINDOW - width + n])
        picked = np.zeros(len(runs), dtype=bool)
        open_ = np.ones(n, dtype=bool)
        for i in range(WINDOW):
            hit = open_ & (runs[i : i + n] == least)
            picked[i : i + n] |= hit
            open_ &= ~hit
        at = np.flatnonzero(picked)
    return runs[at], at


def _all_seeds(docs: DataFrame) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = each(batch.column(0)), each(batch.column(1).cast(pa.binary()))
            found = [(i, *seeds(hashed_words(t))) for i, t in zip(ids, texts)]
            found = [f for f in found if len(f[1])]
            if found:
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate([h for _, h, _ in found]).view(np.int64)),
                        pa.array(np.repeat([i for i, _, _ in found], [len(h) for _, h, _ in found]).astype(np.int64)),
                        pa.array(np.concatenate([p for _, _, p in found]).astype(np.int32)),
                        pa.array(np.concatenate([occurrences(h) for _, h, _ in found]).astype(np.int32)),
                    ],
                    ["seed", "doc_id", "place", "nth"],
                )
        release_memory()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    return rows.mapInArrow(emit, _SEEDS)


def matches(docs: DataFrame) -> DataFrame:
    """owner, doc_id, owner_place, place: a row for each seed of a document and each owner asked for it.

    Those are the seed's own, and the owners of the seeds before and after it in the document, within REACH, so that
    a passage whose seeds have several owners can be followed in one document. Where a document has a seed again, the
    owner's place is that of its same occurrence, or its first where it has fewer."""
    ship_package(docs.sparkSession)
    found = written(_all_seeds(docs), "seeds")
    shared = found.groupBy("seed").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("_last"))
    shared = shared.where("owner < _last").select("seed", "owner")
    hits = written(found.join(shared, "seed"), "hits")
    owners = hits.drop("owner").withColumnRenamed("doc_id", "owner")
    first = owners.groupBy("seed", "owner").agg(F.min("place").alias("owner_place"), F.max("nth").alias("_most"))
    by_place, asked = Window.partitionBy("doc_id").orderBy("place", "owner"), [F.col("owner")]
    for near in (F.lag, F.lead):
        asked.append(F.when(F.abs(near("place").over(by_place) - F.col("place")) <= REACH, near("owner").over(by_place)))
    asked = hits.where("doc_id <> owner").select("seed", "doc_id", "place", "nth", F.array_distinct(F.array(*asked)).alias("_asked"))
    asked = asked.select("seed", "doc_id", "place", "nth", F.explode("_asked").alias("owner")).where("owner is not null")
    found = written(asked.join(first, ["seed", "owner"]), "matches")
    again = owners.where("nth > 0").groupBy("seed", "owner", "nth").agg(F.min("place").alias("owner_place"))
    again = found.where("nth > 0 and nth <= _most").drop("owner_place").join(again, ["seed", "owner", "nth"])
    columns = ["owner", "doc_id", "owner_place", "place"]
    return found.where("nth = 0 or nth > _most").select(columns).unionByName(again.select(columns))


class Fenwick:
    """The largest of the entries (value, match) of the first places of a stretch."""

    def __init__(self) -> None:
        self.best = [_NOTHING] * (REACH + 1)

    def add(self, place: int, entry: tuple[float, int]) -> None:
        at, best = place + 1, self.best
        while at <= REACH:
            if best[at] < entry:
                best[at] = entry
            at += at & -at

    def first(self, count: int) -> tuple[float, int]:
        found, best = _NOTHING, self.best
        while count > 0:
            if best[count] > found:
                found = best[count]
            count -= count & -count
        return found


def follows(before: tuple[int, int], after: tuple[int, int]) -> bool:
    """Whether a match (owner's place, place) can be the next of a chain: further on in both texts, at most REACH words
    in the document, and in the owner in the same stretch of REACH words or the one after it."""
    owner_step = after[0] // REACH - before[0] // REACH
    return after[0] > before[0] and owner_step <= 1 and 0 < after[1] - before[1] <= REACH


def chained(owner_places: list[int], places: list[int]) -> list[list[int]]:
    """Chains, as lists of indices, of matches sorted by owner's place: disjoint, the best first.

    A chain scores SEED for each match less GAP_COST for each word that either text moves on between them. The best
    predecessor of a match has the largest score plus cost of its place among those that it `follows`. Those lie in
    four cells of a stretch of the owner by a stretch of the document; a cell has two Fenwick trees of the matches so
    far, over its places and over its places from the end, so that what is out of reach plays no part. Cells that
    the owner's place has left behind are dropped."""
    n = len(places)
    cells: dict[int, dict[int, tuple[Fenwick, Fenwick]]] = {}
    score, before = [0.0] * n, [-1] * n
    i = 0
    while i < n:
        stretch = owner_places[i] // REACH
        for old in [s for s in cells if s < stretch - 1]:
            del cells[old]
        near = [cells[s] for s in (stretch - 1, stretch) if s in cells]
        end = i
        while end < n and owner_places[end] == owner_places[i]:
            end += 1
        for k in range(i, end):
            here = GAP_COST * (owner_places[k] + places[k])
            best = (here, -1)
            row, inside = divmod(places[k], REACH)
            for trees in near:
                if row in trees:
                    best = max(best, trees[row][0].first(inside))
                if row - 1 in trees:
                    best = max(best, trees[row - 1][1].first(REACH - inside))
            score[k], before[k] = SEED + best[0] - here, best[1]
        ours = cells.setdefault(stretch, {})
        for k in range(i, end):
            row, inside = divmod(places[k], REACH)
            if row not in ours:
                ours[row] = (Fenwick(), Fenwick())
            entry = (score[k] + GAP_COST * (owner_places[k] + places[k]), k)
            ours[row][0].add(inside, entry)
            ours[row][1].add(REACH - 1 - inside, entry)
        i = end
    chains, used = [], [False] * n
    for k in sorted(range(n), key=lambda k: (-score[k], k)):
        chain = []
        while k >= 0 and not used[k]:
            used[k] = True
            chain.append(k)
            k = before[k]
        if chain:
            chains.append(chain[::-1])
    return chains


def chains(found: DataFrame) -> DataFrame:
    """Columns of _CHAINS for all chains, those of a single match too. Pairs are streamed through sorted partitions."""

    def close(owner: int, doc: int, group: list[tuple[int, int]]) -> Iterator[tuple]:
        ours, theirs = [g[0] for g in group], [g[1] for g in group]
        for chain in chained(ours, theirs):
            yield owner, doc, [ours[k] for k in chain], [theirs[k] for k in chain]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        names, pair, group, rows = ["owner", "doc_id", "owner_places", "places"], None, [], []
        pack = lambda: pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        for batch in batches:
            for owner, doc, ours, theirs in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if pair != (owner, doc):
                    if pair:
                        rows.extend(close(*pair, group))
                    pair, group = (owner, doc), []
                group.append((ours, theirs))
            if len(rows) > 2000:
                yield pack()
                rows = []
        if pair:
            rows.extend(close(*pair, group))
        if rows:
            yield pack()
        release_memory()

    return found.repartition("owner", "doc_id").sortWithinPartitions("owner", "doc_id", "owner_place", "place").mapInArrow(emit, _CHAINS)


def _least_edits_matched(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short runs of words (bit-parallel)."""
    where: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        where[w] = where.get(w, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for w in b.tolist():
        m = where.get(w, 0)
        v = ((v + (v & m)) | (v & ~m)) & full
    return len(a) - v.bit_count()


def _reach(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How far two runs go on alike from their begin: (words, matches). Single words may differ; it ends at the last
    match before mismatches outweigh matches by DROP."""
    n = min(len(a), len(b))
    best = matched = score = top = words = 0
    for i in range(n):
        if a[i] == b[i]:
            matched += 1
            score += 1
            if score > top:
                top, words, best = score, i + 1, matched
        else:
            score -= 2
            if score < top - DROP:
                break
    return words, best


def align(a: np.ndarray, b: np.ndarray, at: list[tuple[int, int]]) -> list[tuple[int, int, int, int, float]]:
    """Starts and ends in both texts, and identities, of the parts of a chain of matches `at` (places in a and b).

    A chain below IDENTITY is parted at its widest gap until its parts, at the least single matches, reach it."""
    steps, (x, y) = [], (at[0][0] + SEED, at[0][1] + SEED)
    for u, v in at[1:]:
        matched, gap_a, gap_b = 0, a[x : max(u, x)], b[y : max(v, y)]
        if len(gap_a) == len(gap_b) and (gap_a == gap_b).all():
            matched += len(gap_a)
        elif len(gap_a) and len(gap_b):
            matched += _least_edits_matched(gap_a, gap_b)
        matched += min(u + SEED - x, v + SEED - y, SEED)
        steps.append((matched, max(len(gap_a), len(gap_b))))
        x, y = u + SEED, v + SEED
    parts, open_ = [], [(0, len(at) - 1)]
    while open_:
        i, j = open_.pop()
        (begin_x, begin_y), (end_x, end_y) = at[i], (at[j][0] + SEED, at[j][1] + SEED)
        matched = SEED + sum(m for m, _ in steps[i:j])
        if matched < IDENTITY * max(end_x - begin_x, end_y - begin_y) and i < j:
            k = max(range(i, j), key=lambda k: steps[k][1])
            open_ += [(k + 1, j), (i, k)]
            continue
        for margin in (MARGIN, 0):
            words, more = _reach(a[end_x : end_x + margin], b[end_y : end_y + margin])
            back, gone = _reach(a[max(0, begin_x - margin) : begin_x][::-1], b[max(0, begin_y - margin) : begin_y][::-1])
            longest = max(end_x - begin_x, end_y - begin_y) + words + back
            identity = min(1.0, (matched + more + gone) / longest)
            if identity >= IDENTITY:
                break
        parts.append((begin_x - back, end_x + words, begin_y - back, end_y + words, identity))
    return parts


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("block", T.IntegerType()), T.StructField("words", T.BinaryType())])))
def _blocks(texts: pa.Array, wanted: pa.Array) -> pa.Array:
    out = []
    for text, blocks in zip(each(texts.cast(pa.binary())), each(wanted)):
        words = (hashed_words(text) >> np.uint64(32)).astype("<u4")
        out.append([{"block": k, "words": words[k * BLOCK : (k + 1) * BLOCK].tobytes()} for k in blocks])
    return given_back(pa.array(out, pa.list_(pa.struct([("block", pa.int32()), ("words", pa.binary())]))))


_PART = T.StructType(
    [T.StructField(n, T.IntegerType()) for n in ("owner_start", "owner_end", "start", "end")] + [T.StructField("identity", T.DoubleType())]
)


@F.arrow_udf(T.ArrayType(_PART))
def _aligned(a: pa.Array, b: pa.Array, owner_places: pa.Array, places: pa.Array) -> pa.Array:
    """Words of whole blocks from the block of the first place less MARGIN."""
    out = []
    for x, y, ours, theirs in zip(each(a), each(b), each(owner_places), each(places)):
        first_a, first_b = max(0, ours[0] - MARGIN) // BLOCK * BLOCK, max(0, theirs[0] - MARGIN) // BLOCK * BLOCK
        at = [(u - first_a, v - first_b) for u, v in zip(ours, theirs)]
        parts = align(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), at)
        out.append([dict(zip(_PART.names, (s + first_a, e + first_a, t + first_b, f + first_b, identity))) for s, e, t, f, identity in parts])
    return given_back(pa.array(out, pa.list_(pa.struct([(n, pa.int32()) for n in _PART.names[:4]] + [("identity", pa.float64())]))))


def spans(docs: DataFrame) -> DataFrame:
    """owner, doc_id, owner_start, owner_end, start, end, identity of aligned chains; places count words from 0."""
    found = written(chains(matches(docs)).withColumn("chain", F.monotonically_increasing_id()), "chains")

    def wanted(side: str, places: str) -> DataFrame:
        first = F.floor(F.greatest(F.element_at(places, 1) - MARGIN, F.lit(0)) / BLOCK)
        last = F.floor((F.element_at(places, -1) + SEED + MARGIN) / BLOCK)
        blocks = F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("block")
        return found.select("chain", F.lit(side).alias("side"), F.col("owner" if side == "a" else "doc_id").alias("doc"), blocks)

    asked = wanted("a", "owner_places").unionByName(wanted("b", "places"))
    by_doc = asked.select("doc", "block").distinct().groupBy("doc").agg(F.sort_array(F.collect_list("block")).alias("wanted"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").where("doc is not null and text is not null")
    cut = texts.join(by_doc.hint("shuffle_hash"), "doc").select("doc", F.explode(_blocks(F.col("text"), F.col("wanted"))).alias("_b"))
    blocks = written(cut.select("doc", "_b.block", "_b.words").dropDuplicates(["doc", "block"]), "blocks")
    words = asked.join(blocks, ["doc", "block"]).groupBy("chain", "side")
    words = words.agg(F.sort_array(F.collect_list(F.struct("block", "words"))).alias("_w"))
    words = words.select("chain", "side", F.expr("aggregate(_w, X'', (s, w) -> concat(s, w.words))").alias("words"))
    both = words.groupBy("chain").agg(
        F.max(F.when(F.col("side") == "a", F.col("words"))).alias("_a"), F.max(F.when(F.col("side") == "b", F.col("words"))).alias("_b")
    )
    done = found.join(both, "chain").select(
        "owner", "doc_id", F.explode(_aligned(F.col("_a"), F.col("_b"), F.col("owner_places"), F.col("places"))).alias("_r")
    )
    return done.select("owner", "doc_id", "_r.*").where(F.col("identity") >= IDENTITY)


_PASSAGES = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())] + [T.StructField("owner", T.LongType()), T.StructField("owner_start", T.LongType())])
)


@F.arrow_udf(_PASSAGES)
def _joined(spans: pa.Array) -> pa.Array:
    """Spans joined where at most PART_GAP words lie between; those of LEAST words, with the owner of the longest part."""
    out = []
    for row in spans.to_pylist():
        joined: list[dict] = []
        for s in row:
            part = s["end"] - s["start"]
            if joined and s["start"] <= joined[-1]["end"] + PART_GAP:
                last = joined[-1]
                last["end"] = max(last["end"], s["end"])
                if part > last["part"]:
                    last.update(owner=s["owner"], owner_start=s["owner_start"], part=part)
            else:
                joined.append({**s, "part": part})
        out.append([{k: j[k] for k in ("start", "end", "owner", "owner_start")} for j in joined if j["end"] - j["start"] >= LEAST])
    return pa.array(out, pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end", "owner", "owner_start")])))


def _by_doc(docs: DataFrame) -> DataFrame:
    """doc_id, passages. A document's spans are at most as many as its matches: a few for each of its seeds."""
    found = spans(docs).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end", "owner", "owner_start"))).alias("_s"))
    return found.select("doc_id", _joined(F.col("_s")).alias("passages")).where(F.size("passages") > 0)


def passages(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, end_word (exclusive) of passages that source_doc_id has from source_start_word on."""
    found = _by_doc(docs).select("doc_id", F.explode("passages").alias("_p"))
    return found.select(
        "doc_id",
        F.col("_p.start").alias("start_word"),
        F.col("_p.end").alias("end_word"),
        F.col("_p.owner").alias("source_doc_id"),
        F.col("_p.owner_start").alias("source_start_word"),
    )


@F.arrow_udf(T.StringType())
def _without(texts: pa.Array, passages: pa.Array) -> pa.Array:
    out = []
    for text, cuts in zip(each(texts), each(passages)):
        if text and cuts:
            raw = text.encode()
            begin = np.append(word_spans(np.frombuffer(raw, dtype=np.uint8), NOT_SPACE)[0], len(raw))
            kept, at = [], 0
            for cut in cuts:
                kept.append(raw[at : begin[cut["start"]]])
                at = begin[min(cut["end"], len(begin) - 1)]
            text = b"".join([*kept, raw[at:]]).decode()
        out.append(text)
    return given_back(pa.array(out, pa.string()))


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs without their repeated passages; a document of which nothing but white space is left goes."""
    rows = docs.select("doc_id", F.struct(*docs.columns).alias("row"))
    cut = rows.join(_by_doc(docs).hint("shuffle_hash"), "doc_id", "left")
    touched, text = F.col("passages").isNotNull(), _without(F.col("row.text"), F.col("passages"))
    cut = cut.select("row", touched.alias("touched"), F.when(touched, text).otherwise(F.col("row.text")).alias("text"))
    cut = cut.where(~F.col("touched") | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("touched"), length).otherwise(F.col("row.n_chars"))
    return cut.select([new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
