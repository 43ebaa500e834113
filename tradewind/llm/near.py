"""Near-duplicates by order MinHash, verified by banded alignment.

A text's five-word shingles are labelled with their occurrence, so that each is there once. For each of SKETCHES
random orders, the MINIMA least labelled shingles, kept in the order of the text, make one signature. Texts of equal
signatures are candidates; two texts of similarity s share a given signature with a probability of about s^MINIMA, so
a pair at SIMILARITY is missed by all signatures with a probability of 3e-5. Candidates are verified by aligning their
shingles within a band: similarity is the number of shingles aligned in order by the number of all shingles of both.

Exact copies are one node, named by the md5 of the text, and are neither sketched against each other nor paired.
In buckets of up to SMALL texts all pairs are candidates. In a larger one each text is first paired with one leader, the
text that meets most others in large buckets and so is the likeliest to be similar to them; the links so far merge most
texts of near copies. Then every pair of texts that share a large bucket and are still in different
components is compared by its outlines: the parity of the shingles in each of OUTLINE hash bins. A shingle that only one
of two texts has changes one bin, so outlines that differ in more bins than SIMILARITY allows rule a pair out for sure;
all other pairs are verified. So no candidate is lost, and what is verified are few pairs besides the links themselves.
Classes are the connected components of the verified links. Their id is the least doc_id.

Defined cases: empty texts are exact copies of each other; a null text is never a duplicate; a text of fewer than
five words is one shingle; null ids take part, but a class's id is its least id that isn't null (null if all are);
repeated rows are copies; rows that share an id but not the text are documents of their own; an empty table gives no rows; texts of
any length are read whole; other columns, whatever their names, play no part.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.components import components
from tradewind.llm.shared import each, given_back, ship_package, written
from tradewind.llm.words import hashed_words, mixed, occurrence_labelled, windows

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 20
MINIMA = 4
SMALL = 32
#: Bins of an outline, a power of two; texts of the smaller components of a bucket that a task compares at once, about.
OUTLINE = 1024
BLOCK = 1024
#: Further orders and the lengths of their signatures (`longer_sketches`).
LONGER = 40
LENGTHS = (8, 16, 32)

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = ((mixed(np.arange(1, SKETCHES + LONGER + 1, dtype=np.uint64) * _MULTIPLIER) >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]
_AT_ONCE = 1 << 18


def labelled_shingles(text: bytes | None) -> np.ndarray:
    """The text's five-word shingles in order, each labelled with its occurrence; a shorter text is one shingle."""
    return occurrence_labelled(windows(hashed_words(text), SHINGLE))


def _least(shingles: np.ndarray, count: int, first: int, orders: int) -> np.ndarray:
    """For each of `orders` orders from `first` on, the places of the `count` least shingles, the least first."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.empty((orders, count), dtype=np.int64)
    rows = max(1, _AT_ONCE // len(shingles))
    for i in range(0, orders, rows):
        seeds = _SEEDS[first + i : first + min(i + rows, orders)]
        ranks = short[None, :] * seeds
        ranks ^= ranks >> np.uint32(15)
        ranks *= seeds
        found = np.argpartition(ranks, count - 1, axis=1)[:, :count]
        by_rank = np.argsort(np.take_along_axis(ranks, found, axis=1), axis=1, kind="stable")
        least[i : i + rows] = np.take_along_axis(found, by_rank, axis=1)
    return least


def _signed(shingles: np.ndarray, least: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A hash of each order's shingles, taken in the order of the text."""
    least = np.sort(least, axis=1)
    for place in range(least.shape[1]):
        value = (value ^ shingles[least[:, place]]) * _MULTIPLIER
        value ^= value >> np.uint64(29)
    return value


def sketches(shingles: np.ndarray) -> np.ndarray:
    """Order MinHash: for each of SKETCHES orders, a hash of its MINIMA least shingles in the order of the text."""
    if not len(shingles):
        return np.zeros(SKETCHES, dtype=np.uint64)
    least = _least(shingles, min(MINIMA, len(shingles)), 0, SKETCHES)
    return _signed(shingles, least, np.arange(1, SKETCHES + 1, dtype=np.uint64))


def longer_sketches(shingles: np.ndarray) -> np.ndarray:
    """For each of LONGER further orders, a row of hashes of its least shingles, one for each of LENGTHS.

    Finer sketches for callers that compare texts of large buckets without verifying them; `classes` needs none."""
    least = _least(shingles, min(LENGTHS[-1], len(shingles)), SKETCHES, LONGER)
    orders = np.arange(1, LONGER + 1, dtype=np.uint64) * np.uint64(len(LENGTHS))
    return np.stack([_signed(shingles, least[:, :n], orders + np.uint64(i)) for i, n in enumerate(LENGTHS)], axis=1)


def aligned(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Most shingles that both texts have in the same order, at places at most `band` apart.

    Labelled shingles are distinct within a text, so the best alignment is a longest increasing run of the
    matches within the band; patience sorting finds it."""
    order = np.argsort(b, kind="stable")
    place = order[np.minimum(np.searchsorted(b, a, sorter=order), len(b) - 1)]
    places = place[(b[place] == a) & (np.abs(place - np.arange(len(a))) <= band)]
    if len(places) < 2 or (np.diff(places) > 0).all():
        return len(places)
    ends: list[int] = []
    for p in places.tolist():
        i = bisect_left(ends, p)
        if i == len(ends):
            ends.append(p)
        else:
            ends[i] = p
    return len(ends)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Aligned shingles by all shingles of both; 0 if the lengths rule SIMILARITY out. The band loses no pair: texts as
    similar as SIMILARITY differ by at most (1 - s) / (1 + s) of their shingles, and aligned places by no more."""
    n = len(a) + len(b)
    if not n or min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
        return 0.0
    together = aligned(a, b, int(np.ceil(n * (1 - SIMILARITY) / (1 + SIMILARITY))))
    return together / (n - together)


def _short(shingles: np.ndarray) -> np.ndarray:
    """The shingles as they are aligned."""
    return (shingles >> np.uint64(32)).astype("<u4")


def outline(shingles: np.ndarray) -> np.ndarray:
    """The number of shingles, then OUTLINE bits in numbers of 64: whether a bin has an odd number of them."""
    bins = (shingles * np.uint32(0x9E3779B1)) >> np.uint32(33 - OUTLINE.bit_length())
    odd = np.packbits((np.bincount(bins, minlength=OUTLINE) & 1).astype(np.uint8)).view(np.int64)
    return np.concatenate([np.array([len(shingles)], dtype=np.int64), odd])


@F.arrow_udf(T.ArrayType(T.LongType()))
def _signatures(texts: pa.Array) -> pa.Array:
    made = [sketches(labelled_shingles(t)).view(np.int64) if t else None for t in each(texts.cast(pa.binary()))]
    return given_back(pa.array(made, pa.list_(pa.int64())))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _outlines(texts: pa.Array) -> pa.Array:
    made = [outline(_short(labelled_shingles(t))) for t in each(texts.cast(pa.binary()))]
    return given_back(pa.array(made, pa.list_(pa.int64())))


@F.arrow_udf(T.BinaryType())
def _packed_shingles(texts: pa.Array) -> pa.Array:
    made = [_short(labelled_shingles(t)).tobytes() for t in each(texts.cast(pa.binary()))]
    return given_back(pa.array(made, pa.binary()))


@F.arrow_udf(T.DoubleType())
def _similarity(a: pa.Array, b: pa.Array) -> pa.Array:
    made = [similarity(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")) for x, y in zip(each(a), each(b))]
    return given_back(pa.array(made, pa.float64()))


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def buckets(nodes: DataFrame) -> DataFrame:
    """key, signature, texts: the texts of every signature that several have, and how many these are."""
    bands = nodes.select("key", F.explode("signatures").alias("signature"))
    shared = bands.groupBy("signature").agg(F.count("*").alias("texts")).where("texts > 1")
    return written(bands.join(shared, "signature"), "buckets")


def candidates(members: DataFrame) -> DataFrame:
    """a, b: pairs of keys, a before b, of the buckets of key, signature, texts: all pairs of small buckets and those
    with the leader of large ones, their text that meets most others in all large buckets."""
    together = members.where(F.col("texts") <= SMALL).groupBy("signature").agg(F.sort_array(F.collect_list("key")).alias("all"))
    after = F.transform("all", lambda x, i: F.transform(F.slice("all", i + 2, SMALL), lambda y: F.struct(x.alias("a"), y.alias("b"))))
    pairs = together.select(F.explode(F.flatten(after)).alias("_p")).select("_p.a", "_p.b")
    large = members.where(F.col("texts") > SMALL)
    met = large.groupBy("key").agg(F.sum("texts").alias("met"))
    first = large.join(met, "key").groupBy("signature").agg(F.max(F.struct("met", "key")).alias("first"))
    led = large.join(first.select("signature", F.col("first.key").alias("leader")), "signature").where("key <> leader")
    return pairs.unionByName(led.select(F.least("key", "leader").alias("a"), F.greatest("key", "leader").alias("b"))).distinct()


def texts_of(docs: DataFrame, nodes: DataFrame, needed: DataFrame) -> DataFrame:
    """key, text of the nodes whose key is in `needed`: rows that share the first id of a key, the text's own."""
    needed = nodes.join(needed, "key", "left_semi").select("key", "first")
    texts = docs.select("doc_id", "text", _text_key(F.col("text")).alias("key"))
    same = (F.col("t.key") == F.col("n.key")) & F.col("t.doc_id").eqNullSafe(F.col("n.first"))
    return texts.alias("t").join(needed.alias("n").hint("shuffle_hash"), same, "left_semi").select("key", "text")


def further_candidates(docs: DataFrame, nodes: DataFrame, members: DataFrame, found: DataFrame) -> DataFrame:
    """a, b: all pairs of texts that share a large bucket, are in different components of `found` and may be similar.

    Of two texts in different components one at least is outside the bucket's largest component. Those are dealt to
    blocks, each of which meets all texts of the bucket."""
    labels = found.select(F.col("node").alias("key"), "label")
    large = members.where(F.col("texts") > SMALL).join(labels, "key", "left")
    large = written(large.select("signature", "key", F.coalesce("label", "key").alias("label")), "large")
    sizes = large.groupBy("signature", "label").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("signature").agg(
        F.max_by("label", F.struct("size", "label")).alias("largest"), (F.sum("size") - F.max("size")).alias("others")
    )
    largest = largest.where("others > 0").select("signature", "largest", F.ceil(F.col("others") / BLOCK).cast("int").alias("blocks"))
    unsettled = written(large.join(largest, "signature"), "unsettled")
    made = texts_of(docs, nodes, unsettled.select("key").distinct()).select("key", _outlines(F.col("text")).alias("outline"))
    made = written(made.dropDuplicates(["key"]), "outlines").where("outline[0] > 0")
    # Plain columns: the comparison of arrays is too long a method for the JVM to compile.
    bins = range(1, OUTLINE // 64 + 1)
    made = made.selectExpr("key", "outline[0] AS size", *[f"outline[{i}] AS bins_{i}" for i in bins])
    unsettled = written(unsettled.join(made, "key"), "compared")
    x = unsettled.where("label <> largest").withColumn("block", F.expr("pmod(xxhash64(key), blocks)"))
    y = unsettled.withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1L)")))
    # Texts with n shingles in all differ by at most this share of n; the rest is for the last bit of a product.
    apart = f"{(1 - SIMILARITY) / (1 + SIMILARITY)}D * (x.size + y.size) + 1e-6D"
    odd = " + ".join(f"bit_count(x.bins_{i} ^ y.bins_{i})" for i in bins)
    near = f"x.label <> y.label and (y.label = y.largest or x.key < y.key) and {odd} <= {apart}"
    pairs = x.alias("x").join(y.alias("y"), F.expr(f"x.signature = y.signature and x.block = y.block and {near}"))
    return pairs.select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()


def links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b, similarity of the verified ones of `pairs` of nodes."""
    pairs = written(pairs, "candidates")
    needed = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    packed = texts_of(docs, nodes, needed).select("key", _packed_shingles(F.col("text")).alias("shingles"))
    packed = written(packed.dropDuplicates(["key"]), "shingles")
    both = pairs.join(packed.select(F.col("key").alias("a"), F.col("shingles").alias("_a")), "a")
    both = both.join(packed.select(F.col("key").alias("b"), F.col("shingles").alias("_b")), "b")
    return both.select("a", "b", _similarity(F.col("_a"), F.col("_b")).alias("similarity")).where(F.col("similarity") >= SIMILARITY)


def _named(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of docs as doc_id, key; and key, class_id, first, kept (whether the text stands for its class) of their texts."""
    ship_package(docs.sparkSession)
    rows = docs.select("doc_id", _text_key(F.col("text")).alias("key"), _signatures(F.col("text")).alias("signatures"))
    rows = written(rows, "signatures")
    nodes = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first"), F.any_value("signatures").alias("signatures"))
    nodes = written(nodes, "nodes")
    members = buckets(nodes)
    linked = written(links(docs, nodes, candidates(members)), "links")
    found = components(linked)
    more = written(links(docs, nodes, further_candidates(docs, nodes, members, found)), "links")
    if not more.isEmpty():
        found = components(linked.unionByName(more))
    named = nodes.select("key", "first").join(found.withColumnRenamed("node", "key"), "key", "left")
    named = named.withColumn("label", F.coalesce("label", "key"))
    # The least id stands for its class; of its texts, if it has several in the class, the least key.
    least = named.where("first is not null").groupBy("label").agg(F.min(F.struct("first", "key")).alias("_least"))
    named = named.join(least, "label", "left").select("key", "first", F.col("_least.first").alias("class_id"), (F.col("_least.key") == F.col("key")).alias("kept"))
    return rows.select("doc_id", "key"), named


def classes(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, class_id (least doc_id of its class), text_key and kept.

    Kept are the rows that `without_copies` keeps, repeated rows counted as one: those of the class's least doc_id and
    one of its texts, and those without an id or a text."""
    rows, named = _named(docs)
    found = rows.join(named, "key", "left")
    stays = F.col("doc_id").isNull() | F.col("key").isNull() | (F.col("kept") & (F.col("doc_id") == F.col("first")))
    return found.select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.col("key").alias("text_key"),
        stays.alias("kept"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """docs with one row of each class: that of its least doc_id. Rows of a null id stay."""
    gone = classes(docs).where("not kept").select("doc_id", "text_key").distinct()
    rows = docs.select("doc_id", _text_key(F.col("text")).alias("text_key"), F.struct(*docs.columns).alias("row"))
    rows = rows.join(gone.hint("shuffle_hash"), ["doc_id", "text_key"], "left_anti")
    # Repeated rows of an id and a text are one document.
    alike = Window.partitionBy("doc_id", "text_key").orderBy(F.lit(1))
    first = rows.withColumn("place", F.row_number().over(alike)).where("place = 1 or doc_id is null")
    return first.select([F.col(f"row.`{c}`").alias(c) for c in docs.columns])
