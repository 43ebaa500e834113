"""Source divergence audit by a recount through minimal perfect hashes.

Each language keeps the terms that at least LEAST_DOCS of its documents hold, counted exactly: tasks tally the terms of
their documents in dictionaries of a bounded number of entries and hand them on as partial counts. The kept terms are
dealt to shards by a hash, and for each shard a task builds a minimal perfect hash: buckets of keys, the largest first,
get a displacement that takes their keys to free slots; the last ones, of a single key, name a free slot. A shard keeps
its keys, as any other term has a slot too. A second pass over the documents broadcasts the shards, as many at a time as
fit PASS_BYTES (more take further passes); tasks look up the distinct terms of some texts, compare them with the keys
stored, and increment the slots of dense arrays, one for each (language, source). Their sums are the counts of
each group. Shares are exact: p = 1 + floor(ONE * (count + PRIOR) / (N + PRIOR * V)).

Sums of differences between two sources run over blocks of a language's terms, each a matrix of sources by terms of a
bounded number of cells, so that no language or source is one task's.

Defined cases: null texts, languages and sources count as empty; a text without terms adds nothing, but its group is
there; repeated rows count each; a language without kept terms has differences of 0; equal values rank by item in
UTF-8 order; texts of any length are read whole; an empty table gives no rows; only text, lang and source are read, so
other columns, whatever their names, play no part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.shared import release_memory, ship_package, written
from tradewind.llm.words import mixed

LEAST_DOCS = 30
TOP = 50
PRIOR = 5
ONE = 1_000_000_000
#: Kept terms of a shard, about, and bytes of the shards that one pass broadcasts.
SHARD_KEYS = 1 << 14
PASS_BYTES = 32_000_000
#: Distinct terms of a task's tally, occurrences that it looks up together, and bytes of its dense slots.
TALLY = 200_000
TOGETHER = 300_000
SLOT_BYTES = 48_000_000
#: Tasks whose counts are added up together.
MERGED = 64
#: Sources times terms of a block.
CELLS = 1 << 16

_TERMS = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: Between a language and a term in a key; no UTF-8 text has this byte.
_BETWEEN = b"\xff"
_SLOT_BITS = 32
_SEED = 42  # of Spark's xxhash64
_STEP = np.uint64(0x9E3779B97F4A7C15)


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text, A to Z lower-cased."""
    return _TERMS.findall(text.lower()) if text else []


def key_hash(key: bytes) -> int:
    """As xxhash64 of Spark, unsigned."""
    return xxhash.xxh64_intdigest(key, _SEED)


def _slots(hashes: np.ndarray, displacement: np.ndarray | np.uint64, size: int) -> np.ndarray:
    return mixed(hashes + displacement * _STEP) % np.uint64(size)


@dataclass(frozen=True)
class Shard:
    """A minimal perfect hash of keys: the key of slot i lies in blob from offsets[i] to offsets[i + 1].

    Keys whose 64-bit hash another key of the shard has as well aren't hashed: they have the last slots, by `others`."""

    displacements: np.ndarray
    offsets: np.ndarray
    blob: bytes
    others: dict[bytes, int] = field(default_factory=dict)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def size(self) -> int:
        return len(self.blob) + self.displacements.nbytes + self.offsets.nbytes

    def key(self, slot: int) -> bytes:
        return self.blob[self.offsets[slot] : self.offsets[slot + 1]]

    def slots(self, hashes: np.ndarray, keys: list[bytes]) -> np.ndarray:
        """The slot of each key, verified against the key stored there; -1 for keys that the shard lacks."""
        hashed = len(self) - len(self.others)
        if not hashed or not keys:
            return np.full(len(keys), -1, np.int64)
        d = self.displacements[hashes % np.uint64(len(self.displacements))]
        slots = np.where(d < 0, -d - 1, _slots(hashes, np.maximum(d, 0).astype(np.uint64), hashed).astype(np.int64))
        begin, end, blob = self.offsets[slots].tolist(), self.offsets[slots + 1].tolist(), self.blob
        stored = [blob[i:j] == key for i, j, key in zip(begin, end, keys)]
        return np.where(stored, slots, [self.others.get(key, -1) for key in keys] if self.others else -1)


def build_shard(keys: list[bytes]) -> Shard:
    """The minimal perfect hash of distinct keys."""
    all_hashes = np.array([key_hash(k) for k in keys], dtype=np.uint64)
    _, first = np.unique(all_hashes, return_index=True)
    n = len(first)
    alone = np.zeros(len(keys), dtype=bool)
    alone[first] = True
    hashes, hashed = all_hashes[alone], [k for k, a in zip(keys, alone) if a]
    displacements = np.zeros(max(1, n // 4), dtype=np.int64)
    bucket = (hashes % np.uint64(len(displacements))).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
    members = sorted((order[i:j] for i, j in zip(edges, edges[1:])), key=len, reverse=True)
    taken = np.zeros(n, dtype=bool)
    slot = np.zeros(n, dtype=np.int64)
    at = 0
    while at < len(members) and len(members[at]) > 1:
        mine, tried = members[at], 0
        while True:
            # Displacements are tried many at a time: each row is a displacement, each column a key.
            some = np.arange(tried, tried + 64, dtype=np.uint64)
            places = _slots(hashes[mine][None, :], some[:, None], n).astype(np.int64)
            apart = np.sort(places, axis=1)
            fits = ~taken[places].any(axis=1) & (apart[:, 1:] != apart[:, :-1]).all(axis=1)
            if fits.any():
                chosen = int(np.argmax(fits))
                break
            tried += 64
        displacements[bucket[mine[0]]] = tried + chosen
        slot[mine], taken[places[chosen]] = places[chosen], True
        at += 1
    for mine, free in zip(members[at:], np.flatnonzero(~taken)):
        displacements[bucket[mine[0]]] = -free - 1
        slot[mine] = free
    ordered: list[bytes] = [b""] * n
    for place, key in zip(slot.tolist(), hashed):
        ordered[place] = key
    others = [k for k, a in zip(keys, alone) if not a]
    ordered += others
    offsets = np.zeros(len(ordered) + 1, dtype=np.int64)
    np.cumsum([len(k) for k in ordered], out=offsets[1:])
    return Shard(displacements, offsets, b"".join(ordered), {k: n + i for i, k in enumerate(others)})


def _groups(docs: DataFrame) -> list:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term of the terms that at least `least_docs` documents of the language hold."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def pack() -> pa.RecordBatch:
            rows = [(lang, term, n) for lang, counter in counts.items() for term, n in counter.items()]
            counts.clear()
            langs, found, numbers = zip(*rows)
            columns = [pa.array(langs, pa.string()), pa.array(found, pa.binary()).cast(pa.string()), pa.array(numbers, pa.int64())]
            return pa.record_batch(columns, ["lang", "term", "docs"])

        held = 0
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for i, lang in enumerate(langs):
                counter = counts.setdefault(lang, Counter())
                held -= len(counter)
                counter.update(set(terms(texts[i].as_py())))
                held += len(counter)
                if held > TALLY:
                    yield pack()
                    held = 0
        if held:
            yield pack()
        release_memory()

    lang = _groups(docs)[0]
    parts = docs.select(lang, F.col("text").cast("string").alias("text")).mapInArrow(tally, "lang string, term string, docs long")
    return parts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).select("lang", "term")


def _packed_shards(kept: DataFrame, shard_keys: int) -> DataFrame:
    """shard, size and the parts of a Shard for each shard of the kept terms."""
    shards = max(1, -(-kept.count() // shard_keys))
    key = F.concat(F.col("lang").cast("binary"), F.lit(_BETWEEN), F.col("term").cast("binary"))
    keyed = kept.select(key.alias("key"))
    # The upper bits of the hash choose the shard, the whole of it the slot.
    number = F.pmod(F.shiftrightunsigned(F.xxhash64("key"), 40), F.lit(shards)).cast("int")

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        made = build_shard([bytes(k) for k in rows["key"]])
        parts = {
            "shard": int(rows["shard"].iloc[0]), "size": made.size, "displacements": made.displacements.astype("<i8").tobytes(),
            "offsets": made.offsets.astype("<i8").tobytes(), "blob": made.blob, "others": len(made.others),
        }
        return pd.DataFrame([parts])

    schema = "shard int, size long, displacements binary, offsets binary, blob binary, others int"
    made = keyed.select(number.alias("shard"), "key").groupBy("shard").applyInPandas(build, schema)
    return written(made, "shards").withColumn("shards", F.lit(shards))


def _unpacked(row) -> Shard:
    offsets = np.frombuffer(row["offsets"], "<i8")
    shard = Shard(np.frombuffer(row["displacements"], "<i8"), offsets, bytes(row["blob"]))
    n = len(shard)
    shard.others.update({shard.key(i): i for i in range(n - row["others"], n)})
    return shard


class _Places:
    """The slots of some shards, numbered within each language."""

    def __init__(self, shards: dict[int, Shard]) -> None:
        self.shards = shards
        self.begin = dict(zip(shards, np.cumsum([0, *map(len, shards.values())]).tolist()))
        langs = [shard.key(i).split(_BETWEEN)[0].decode() for shard in shards.values() for i in range(len(shard))]
        #: By language, its places among the slots of all shards.
        self.of_lang = {lang: np.flatnonzero(np.array(langs) == lang) for lang in set(langs)}
        self.within = np.full(len(langs), -1, dtype=np.int64)
        for places in self.of_lang.values():
            self.within[places] = np.arange(len(places))

    def of_terms(self, lang: str, distinct: list[bytes], of: int) -> np.ndarray:
        """The place of each term within its language, -1 for terms that these shards lack."""
        start = lang.encode() + _BETWEEN
        keys = [start + term for term in distinct]
        hashes = np.array([key_hash(k) for k in keys], dtype=np.uint64)
        shard_of, found = (hashes >> np.uint64(40)) % np.uint64(of), np.full(len(keys), -1, dtype=np.int64)
        for number, shard in self.shards.items():
            at = np.flatnonzero(shard_of == number)
            if len(at):
                slots = shard.slots(hashes[at], [keys[i] for i in at.tolist()])
                found[at] = np.where(slots >= 0, self.within[slots + self.begin[number]], -1)
        return found

    def by_shard(self, lang: str, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Shard, slots and counts of a language's places that aren't 0."""
        some = np.flatnonzero(counts)
        places = self.of_lang[lang][some]
        for number, shard in self.shards.items():
            i, j = np.searchsorted(places, (self.begin[number], self.begin[number] + len(shard)))
            if i < j:
                yield number, places[i:j] - self.begin[number], counts[some[i:j]]


_COUNTS = "lang string, source string, shard int, task int, slots binary, counts binary"


def _partial_counts(docs: DataFrame, shards: dict[int, Shard], of: int) -> DataFrame:
    """Columns of _COUNTS: what a task counted of a group in a shard, as packed slots and counts."""
    known = docs.sparkSession.sparkContext.broadcast(shards)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, task = _Places(known.value), TaskContext.get().partitionId()
        dense: dict[tuple[str, str], np.ndarray] = {}
        tallied: dict[str, dict[str, list[list[bytes]]]] = {}

        def add_up() -> None:
            """Occurrences by language and source into the dense slots; a language's distinct terms are looked up once."""
            for lang, sources in tallied.items():
                if lang not in places.of_lang:
                    continue
                distinct = list(dict.fromkeys(chain.from_iterable(chain.from_iterable(sources.values()))))
                slot = dict(zip(distinct, places.of_terms(lang, distinct, of).tolist()))
                for source, lists in sources.items():
                    found = np.fromiter(map(slot.__getitem__, chain.from_iterable(lists)), dtype=np.int64)
                    if (found := found[found >= 0]).size:
                        ours = dense.setdefault((lang, source), np.zeros(len(places.of_lang[lang]), dtype=np.int64))
                        np.add.at(ours, found, 1)
            tallied.clear()

        def pack() -> Iterator[pa.RecordBatch]:
            rows = [
                (lang, source, number, task, slots.astype("<i4").tobytes(), counts.astype("<i8").tobytes())
                for (lang, source), ours in dense.items()
                for number, slots, counts in places.by_shard(lang, ours)
            ]
            dense.clear()
            if rows:
                types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                names = ["lang", "source", "shard", "task", "slots", "counts"]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        held = 0
        for batch in batches:
            langs, sources, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())
            for i, (lang, source) in enumerate(zip(langs, sources)):
                found = terms(texts[i].as_py())
                if not found:
                    continue
                tallied.setdefault(lang, {}).setdefault(source, []).append(found)
                held += len(found)
                if held > TOGETHER:
                    add_up()
                    held = 0
                    if sum(ours.nbytes for ours in dense.values()) > SLOT_BYTES:
                        yield from pack()
        add_up()
        yield from pack()
        release_memory()

    return docs.select(*_groups(docs), F.col("text").cast("string").alias("text")).mapInArrow(count, _COUNTS)


def _added(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Slots and counts of the packed rows together."""
    slots = np.concatenate([np.frombuffer(x, "<i4") for x in rows["slots"]])
    counts = np.zeros(int(slots.max()) + 1, dtype=np.int64)
    np.add.at(counts, slots, np.concatenate([np.frombuffer(x, "<i8") for x in rows["counts"]]))
    some = np.flatnonzero(counts)
    return some, counts[some]


def _merged_counts(partial: DataFrame) -> DataFrame:
    """lang, source, slot, count: partial counts added up, those of MERGED tasks at a time, so that a group that every
    task has is no large group of rows."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        slots, counts = _added(rows)
        row = {c: rows[c].iloc[0] for c in ("lang", "source", "shard", "task")}
        return pd.DataFrame([{**row, "slots": slots.astype("<i4").tobytes(), "counts": counts.astype("<i8").tobytes()}])

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        slots, counts = _added(rows)
        number = np.int64(rows["shard"].iloc[0]) << _SLOT_BITS
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "source": rows["source"].iloc[0], "slot": number + slots, "count": counts})

    tasks = (partial.agg(F.max("task")).collect()[0][0] or 0) + 1
    by = ["lang", "source", "shard"]
    while tasks > MERGED:
        tasks = -(-tasks // MERGED)
        together = partial.withColumn("task", (F.col("task") / MERGED).cast("int")).groupBy(*by, "task")
        partial = written(together.applyInPandas(merge, _COUNTS), "recount")
    return partial.groupBy(*by).applyInPandas(finish, "lang string, source string, slot long, count long")


def _keys(packed: DataFrame) -> DataFrame:
    """slot, lang, term of all shards."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = _unpacked(row)
                found = [shard.key(i).split(_BETWEEN) for i in range(len(shard))]
                slots = (np.int64(row["shard"]) << _SLOT_BITS) + np.arange(len(shard))
                columns = [pa.array(slots), *[pa.array([f[i] for f in found], pa.binary()).cast(pa.string()) for i in (0, 1)]]
                yield pa.record_batch(columns, ["slot", "lang", "term"])

    return packed.mapInArrow(unpack, "slot long, lang string, term string")


def recount(docs: DataFrame, kept: DataFrame, shard_keys: int = SHARD_KEYS, pass_bytes: int = PASS_BYTES) -> tuple[DataFrame, DataFrame]:
    """lang, source, slot, count: how often each group has each kept term of its language, where it has it; and the
    slots' slot, lang, term.

    The driver gets the shards of one pass at a time: `pass_bytes`, or one shard."""
    packed = _packed_shards(kept, shard_keys)
    sizes = packed.select("shard", "size", "shards").orderBy("shard").collect()
    passes: list[list[int]] = []
    room = 0
    for row in sizes:
        if not passes or row["size"] > room:
            passes.append([])
            room = pass_bytes
        passes[-1].append(row["shard"])
        room -= row["size"]
    counted = docs.sparkSession.createDataFrame([], "lang string, source string, slot long, count long")
    for numbers in passes:
        shards = {r["shard"]: _unpacked(r) for r in packed.where(F.col("shard").between(numbers[0], numbers[-1])).collect()}
        partial = written(_partial_counts(docs, shards, sizes[0]["shards"]), "recount")
        counted = counted.unionByName(_merged_counts(partial))
    return written(counted, "counts"), _keys(packed)


def _share(count: str, total: str, kept: str) -> str:
    """1 + floor(ONE * (count + PRIOR) / (total + PRIOR * kept)), in decimals of whole numbers; null without kept terms."""
    above, below = f"CAST({count} + {PRIOR} AS decimal(20,0)) * {ONE}", f"CAST({total} + {PRIOR} * {kept} AS decimal(20,0))"
    return f"CASE WHEN {kept} > 0 THEN 1L + ({above}) div ({below}) END"


def groups(docs: DataFrame, counts: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total (of the group's kept terms), kept (terms of the language), sources (of the language)."""
    there = docs.select(*_groups(docs)).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    found = there.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "kept"])
    wide = found.groupBy("lang").agg(F.count("*").alias("sources"))
    return written(found.join(wide, "lang"), "groups")


def pair_differences(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source of the language), value: differences summed over all kept terms."""
    blocks = F.expr(f"greatest(1L, ceil(kept * sources / {CELLS}))").cast("int")
    sized = groups.withColumn("blocks", blocks)
    shares = counts.join(sized, ["lang", "source"]).select(
        "lang", "source", "slot", F.expr(_share("count", "total", "kept")).alias("share"), F.expr("pmod(xxhash64(slot), blocks)").cast("int").alias("block")
    )
    # A row without a slot tells each block of a source and its share of absent terms.
    absent = sized.select(
        "lang", "source", F.lit(None).cast("long").alias("slot"), F.expr(_share("0", "total", "kept")).alias("share"),
        F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
    )

    def differences(rows: pd.DataFrame) -> pd.DataFrame:
        lang, plain = rows["lang"].iloc[0], rows["slot"].isna()
        base = rows[plain].sort_values("source")
        names = base["source"].tolist()
        of, at = pd.Index(names), pd.factorize(rows.loc[~plain, "slot"])
        shares = np.repeat(base["share"].fillna(0).to_numpy(np.int64)[:, None], len(at[1]), axis=1)
        shares[of.get_indexer(rows.loc[~plain, "source"]), at[0]] = rows.loc[~plain, "share"].to_numpy(np.int64)
        out = [np.abs(shares - ours).sum(axis=1) for ours in shares]
        n = len(names)
        made = pd.DataFrame({"lang": lang, "source": np.repeat(names, n), "item": np.tile(names, n), "value": np.concatenate(out)})
        return made[made["source"] != made["item"]]

    both = shares.unionByName(absent).groupBy("lang", "block")
    parts = both.applyInPandas(differences, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_differences(counts: DataFrame, keys: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (a term that the group has, more often than its language), value."""
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("kept").alias("kept"))
    whole = counts.groupBy("slot").agg(F.sum("count").alias("lang_count")).join(keys, "slot").join(langs, "lang")
    whole = whole.select("slot", F.col("term").alias("item"), F.expr(_share("lang_count", "lang_total", "kept")).alias("q"))
    ours = counts.join(groups, ["lang", "source"]).select("lang", "source", "slot", F.expr(_share("count", "total", "kept")).alias("p"))
    return ours.join(whole, "slot").where("p > q").select("lang", "source", "item", F.expr("p - q").alias("value"))


def _ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    ship_package(docs.sparkSession)
    kept = written(kept_terms(docs, least_docs), "terms")
    counts, keys = recount(docs, kept)
    known = groups(docs, counts, kept)
    pairs = _ranked(pair_differences(counts, known), "pair")
    return pairs.unionByName(_ranked(term_differences(counts, keys, known), "term", top))
