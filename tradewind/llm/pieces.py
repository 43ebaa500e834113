"""SentencePiece encoding and decoding of merge-type (BPE) models, by backtracking.

A merge-type model joins, again and again, the best-scored neighbouring pair whose joined text is a piece, the leftmost
of equal ones. Its result is the only way to write a text as pieces such that every piece encodes to itself and every
two neighbours, encoded together, stay apart. So a text is encoded from left to right: at each place an Aho-Corasick
automaton gives the longest piece, two neighbours are checked by merging their characters anew, and where no piece
fits, the place is marked in a bitfield as failed and the piece before is replaced by its longest shorter prefix. What
lies before a place is always the encoding of the text so far, so a place is tried once and the work is linear.

A text is first cut where no piece can reach across: before a mark of white space, and around line feeds, as far as
the vocabulary allows it. Ids of distinct cuts are kept, in a task, in a dictionary of a bounded number of bytes.
Characters that are no pieces become their UTF-8 bytes' ids. Decoding joins the pieces' texts, without one leading
blank; bytes that are no UTF-8 become U+FFFD each.

The vocabulary is read on the driver and broadcast (bounded by the model); tasks need no file. Models whose texts
are altered before encoding (other than by a leading mark and marks for blanks), or that the library encodes otherwise,
are refused.

Defined cases: a null or empty text has the begin and end ids alone and decodes to an empty text; texts of any length
are encoded whole; repeated rows are encoded each on its own; null ids are kept; an empty table gives no rows; only
doc_id and text are read, so other columns, whatever their names, play no part.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.shared import release_memory, ship_package

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
#: Bytes that the ids kept for cuts may take, in each of two generations, and characters of the longest cut kept.
KEPT_BYTES = 32_000_000
KEPT_CHARS = 64
#: Pairs of neighbours whose check is kept, and pieces whose merges are.
KEPT_PAIRS = 100_000
KEPT_EDGES = 20_000
_ENTRY = 200
_NO_MERGE = float("-inf")
_BLOCK = 4096
#: New cuts that take their steps together, and how few of them are better taken one by one.
_TOGETHER = 1 << 14
_FEW = 200
#: Characters of the texts that a task encodes together.
_SLICE = 1_500_000
_REPLACEMENT = "�".encode()
_PROBE = "AÅÅ ﬁＡ  a\tb\n c "

CODED = "doc_id long, ids binary, n_tokens long, decoded string"


@dataclass(frozen=True)
class PieceModel:
    """scores: of the pieces that merges may give; whole: those that encode to themselves; texts: of all ids, decoded."""

    ids: dict[str, int]
    scores: dict[str, float]
    whole: frozenset[str]
    byte_ids: tuple[int, ...]
    texts: tuple[bytes, ...]
    unknown: int
    begin: int
    end: int


def merges(text: str, scores: dict[str, float]) -> list[tuple[float, list[str]]]:
    """How a short text's characters are merged, the best pair first, the leftmost of equal ones: the parts before each
    merge with its score, and at last the parts that stay, with a score below all others."""
    parts, steps = list(text), []
    while True:
        best, at = _NO_MERGE, -1
        for i in range(len(parts) - 1):
            score = scores.get(parts[i] + parts[i + 1])
            if score is not None and score > best:
                best, at = score, i
        steps.append((best, parts))
        if at < 0:
            return steps
        parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]


def read_model(path: str) -> PieceModel:
    """The vocabulary of a merge-type model file with byte fallback."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=path)
    if library.normalize(_PROBE) != MARK + _PROBE.replace(" ", MARK):
        raise ValueError("the model alters texts beyond marking their blanks")
    ids, scores, byte_ids, texts = {}, {}, {}, []
    for i in range(len(library)):
        piece = library.id_to_piece(i)
        if library.is_control(i):
            texts.append(b"")
        elif library.is_unknown(i):
            texts.append(library.decode([i]).encode())
        elif library.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
            texts.append(bytes([int(piece[3:-1], 16)]))
        else:
            ids[piece], scores[piece] = i, library.get_score(i)
            texts.append(piece.replace(MARK, " ").encode())
    if len(byte_ids) != 256:
        raise ValueError("the model has no ids for bytes")
    whole = frozenset(p for p in scores if merges(p, scores)[-1][1] == [p])
    in_order = tuple(byte_ids[b] for b in range(256))
    model = PieceModel(ids, scores, whole, in_order, tuple(texts), library.unk_id(), library.bos_id(), library.eos_id())
    coder = Coder(model)
    for probe in (_PROBE, *(" ".join(list(ids)[i::97]) for i in range(97))):
        found = library.encode(probe)
        if np.frombuffer(coder.encode(probe, False, False), "<u4").tolist() != found or coder.decode(np.array(found)) != library.decode(found):
            raise ValueError("the library encodes otherwise with this model")
    return model


class Coder:
    """Encodes and decodes with one model. What it keeps is bounded; one lives as long as a task.

    Pieces that encode to themselves are numbered; a character that is no piece has the numbers' end plus its code point.
    """

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.pieces = sorted(model.whole)
        self.end = len(self.pieces)
        number = {piece: i for i, piece in enumerate(self.pieces)}
        self.automaton = ahocorasick.Automaton()
        for piece, i in number.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.lengths = list(map(len, self.pieces))
        self.longest_piece = max(self.lengths, default=1)
        # The longest piece that is a proper prefix, -1 for none.
        self.shorter = [next((number[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in number), -1) for p in self.pieces]
        self.packed = [model.ids[p].to_bytes(4, "little") for p in self.pieces]
        self.length_of, self.shorter_of = np.array(self.lengths), np.array(self.shorter)
        self.id_of = np.array([model.ids[p] for p in self.pieces])
        self.pairs: dict[int, bool] = {}
        self.pair_keys, self.pair_fits = np.array([-1]), np.array([False])
        self.edges: dict[int, list[tuple[float, str, str]]] = {}
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0
        # A cut is safe where no piece holds what stands on its two sides.
        line = "" if any("\n" in p and len(p) > 1 for p in model.whole) else "\n"
        self.cut_at_lines = bool(line)
        marks_lead = not any(MARK in p.lstrip(MARK) for p in model.whole)
        if marks_lead:
            self.cuts = re.compile(f"{MARK}*[^{MARK}{line}]+|{MARK}+" + (line and "|\n")).findall
        else:
            self.cuts = re.compile(f"[^{line}]+|{line}" if line else "(?s).+").findall
        self.is_byte = np.zeros(len(model.texts), dtype=bool)
        self.is_byte[list(model.byte_ids)] = True
        self.is_control = np.array([not t for t in model.texts])
        self.no_mark = self.is_byte.copy()
        self.no_mark[model.unknown] = True

    def _text(self, piece: int) -> str:
        return self.pieces[piece] if piece < self.end else chr(piece - self.end)

    def _edges(self, piece: int) -> list[tuple[float, str, str]]:
        """The merges of a piece's characters: score, first and last part before each, at last of the whole piece."""
        edges = self.edges.get(piece)
        if edges is None:
            if len(self.edges) >= KEPT_EDGES:
                self.edges.clear()
            steps = merges(self._text(piece), self.model.scores)
            edges = self.edges[piece] = [(score, parts[0], parts[-1]) for score, parts in steps]
        return edges

    def _fit(self, a: int, b: int) -> bool:
        """Whether two pieces stay apart when their characters are merged anew.

        Each merge of the two together is one of either piece, until the last part of the one and the first part of the
        other are the best pair: better than the next merge on the left, and no worse than that on the right."""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        left, right, i, j, scores = self._edges(a), self._edges(b), 0, 0, self.model.scores
        while True:
            (ours, _, last), (theirs, first, _) = left[i], right[j]
            across = scores.get(last + first)
            if across is not None and across > ours and across >= theirs:
                fits = False
                break
            if ours == theirs == _NO_MERGE:
                fits = True
                break
            if ours >= theirs:
                i += 1
            else:
                j += 1
        self.pairs[a << 21 | b] = fits
        return fits

    def _longest(self, text: str) -> list[int]:
        """The longest piece at each place of a short text, by one pass of the automaton."""
        found = [-1] * len(text)
        lengths = self.lengths
        for last, piece in self.automaton.iter(text):
            found[last + 1 - lengths[piece]] = piece  # of those that begin at a place the longest ends last
        if -1 in found:
            found = [self.end + ord(c) if p < 0 else p for p, c in zip(found, text)]
        return found

    def _blocks(self, text: str) -> Callable[[int], int]:
        """The longest piece at a place of a long text, worked out block by block; the last two blocks are kept."""
        blocks: dict[int, list[int]] = {}

        def at(place: int) -> int:
            number = place // _BLOCK
            if number not in blocks:
                while len(blocks) > 1:
                    del blocks[next(iter(blocks))]
                begin = number * _BLOCK
                blocks[number] = self._longest(text[begin : begin + _BLOCK + self.longest_piece - 1])
            return blocks[number][place - number * _BLOCK]

        return at

    def backtracked(self, text: str) -> list[int]:
        """The numbers of the pieces of a text."""
        size, end_of_pieces, lengths, shorter, pairs = len(text), self.end, self.lengths, self.shorter, self.pairs
        longest = self._longest(text).__getitem__ if size <= _BLOCK else self._blocks(text)
        failed = bytearray(size // 8 + 1)
        found: list[int] = []
        at, before = 0, -1
        piece = longest(0) if size else -1
        while at < size:
            end = at + (lengths[piece] if piece < end_of_pieces else 1)
            fits = not failed[end >> 3] >> (end & 7) & 1
            if fits and before >= 0:
                fits = pairs.get(before << 21 | piece)
                if fits is None:
                    fits = self._fit(before, piece)
            if fits:
                found.append(piece)
                at, before = end, piece
                if at < size:
                    piece = longest(at)
                continue
            piece = shorter[piece] if piece < end_of_pieces else -1
            if piece < 0:
                failed[at >> 3] |= 1 << (at & 7)
                piece = found.pop()
                at -= lengths[piece] if piece < end_of_pieces else 1
                before = found[-1] if found else -1
        return found

    def _ids(self, piece: int) -> bytes:
        if piece < self.end:
            return self.packed[piece]
        return b"".join(self.model.byte_ids[b].to_bytes(4, "little") for b in self._text(piece).encode())

    def _fits(self, keys: np.ndarray) -> np.ndarray:
        """Whether the pairs of pieces, packed into numbers, stay apart."""
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        if (new := np.unique(keys[self.pair_keys[at] != keys])).size:
            found = [self._fit(key >> 21, key & (1 << 21) - 1) for key in new.tolist()]
            if len(self.pair_keys) + len(new) > KEPT_PAIRS:
                self.pair_keys, self.pair_fits = self.pair_keys[:1], self.pair_fits[:1]
                return self._fits(keys) if len(new) < KEPT_PAIRS else np.isin(keys, new[found])
            places = np.searchsorted(self.pair_keys, new)
            self.pair_keys = np.insert(self.pair_keys, places, new)
            self.pair_fits = np.insert(self.pair_fits, places, found)
            at = np.searchsorted(self.pair_keys, keys)
        return self.pair_fits[at]

    def backtracked_together(self, texts: list[str]) -> list[bytes]:
        """The packed ids of many short cuts: the steps of `backtracked`, taken by all of them at once.

        No piece reaches across a line feed, so one pass of the automaton over all gives the longest pieces."""
        sizes = np.array(list(map(len, texts)))
        begin = np.cumsum(sizes + 1) - sizes - 1
        whole = "\n".join(texts)
        longest = np.full(len(whole), -1, dtype=np.int64)
        matches = np.fromiter(chain.from_iterable(self.automaton.iter(whole)), dtype=np.int64).reshape(-1, 2)
        longest[matches[:, 0] + 1 - self.length_of[matches[:, 1]]] = matches[:, 1]  # the last of a place is the longest
        odd = np.flatnonzero(longest < 0)
        longest[odd] = [self.end + ord(whole[i]) for i in odd.tolist()]
        most = int(sizes.max())
        stack = np.zeros((len(texts), most + 1), dtype=np.int64)
        failed = np.zeros((len(texts), most + 1), dtype=bool)
        at, depth = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
        piece = longest[begin]
        active = np.arange(len(texts))
        while len(active):
            ours, known = piece[active], piece[active] < self.end
            clipped = np.where(known, ours, 0)
            end = at[active] + np.where(known, self.length_of[clipped], 1)
            fits = ~failed[active, end]
            check = np.flatnonzero(fits & (depth[active] > 0))
            before = stack[active[check], depth[active[check]] - 1]
            fits[check] = self._fits(before << 21 | ours[check])
            on, back = active[fits], active[~fits]
            stack[on, depth[on]] = piece[on]
            depth[on] += 1
            at[on] = end[fits]
            more = on[at[on] < sizes[on]]
            piece[more] = longest[begin[more] + at[more]]
            piece[back] = np.where(known[~fits], self.shorter_of[clipped[~fits]], -1)
            stuck = back[piece[back] < 0]
            failed[stuck, at[stuck]] = True
            depth[stuck] -= 1
            piece[stuck] = stack[stuck, depth[stuck]]
            at[stuck] -= np.where(piece[stuck] < self.end, self.length_of[np.minimum(piece[stuck], self.end - 1)], 1)
            active = np.concatenate([more, back])
        taken = np.arange(most + 1)[None, :] < depth[:, None]
        plain = ~(taken & (stack >= self.end)).any(axis=1)
        packed = self.id_of[np.minimum(stack, self.end - 1)[taken]].astype("<u4").tobytes()
        ends = (4 * np.cumsum(depth)).tolist()
        out = [packed[i:j] for i, j in zip([0, *ends], ends)]
        for row in np.flatnonzero(~plain).tolist():
            out[row] = b"".join(map(self._ids, stack[row, : depth[row]].tolist()))
        return out

    def _learn(self, cuts: set[str]) -> list[str]:
        """Afterwards self.kept has all the cuts. Gives those too long to stay."""
        if self.size > KEPT_BYTES:
            self.kept, self.older, self.size = {}, self.kept, 0
        kept, older = self.kept, self.older
        new, long = [], []
        for cut in cuts.difference(kept):
            if cut in older:
                kept[cut] = older[cut]
                self.size += _ENTRY + 2 * len(cut) + len(kept[cut])
            elif len(cut) > KEPT_CHARS:
                long.append(cut)
            else:
                new.append(cut)
        for i in range(0, len(new), _TOGETHER):
            some = new[i : i + _TOGETHER]
            if len(some) < _FEW or not self.cut_at_lines:
                found = [b"".join(map(self._ids, self.backtracked(cut))) for cut in some]
            else:
                found = self.backtracked_together(some)
            kept.update(zip(some, found))
            self.size += _ENTRY * len(some) + 2 * sum(map(len, some)) + sum(map(len, found))
        for cut in long:
            kept[cut] = b"".join(map(self._ids, self.backtracked(cut)))
        return long

    def encode_all(self, texts: list[str | None], begin: bool = True, end: bool = True) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        cuts = [self.cuts(MARK + text.replace(" ", MARK)) if text else [] for text in texts]
        long = self._learn(set(chain.from_iterable(cuts)))
        first = self.model.begin.to_bytes(4, "little") if begin else b""
        last = self.model.end.to_bytes(4, "little") if end else b""
        out = [first + b"".join(map(self.kept.__getitem__, found)) + last for found in cuts]
        for cut in long:
            del self.kept[cut]
        return out

    def encode(self, text: str | None, begin: bool = True, end: bool = True) -> bytes:
        return self.encode_all([text], begin, end)[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: one leading blank of the first piece is no part of it."""
        spoken = np.flatnonzero(~self.is_control[ids])
        if not len(spoken):
            return ""
        ids = ids[spoken[0] : spoken[-1] + 1]
        texts = list(map(self.model.texts.__getitem__, ids.tolist()))
        if not self.no_mark[ids[0]] and texts[0].startswith(b" "):
            texts[0] = texts[0][1:]
        if len(spoken) == len(ids):
            try:
                return b"".join(texts).decode()
            except UnicodeDecodeError:
                pass
        return b"".join(self._mended(texts, self.is_byte[ids])).decode()

    @staticmethod
    def _mended(texts: list[bytes], is_byte: np.ndarray) -> Iterator[bytes]:
        """Each byte that is no part of a character becomes a replacement character; no character reaches across other ids."""
        edges = np.flatnonzero(np.diff(is_byte.view(np.int8))) + 1
        bounds = [0, *edges.tolist(), len(texts)]
        for i, j in zip(bounds, bounds[1:]):
            run = b"".join(texts[i:j])
            while is_byte[i] and run:
                try:
                    run.decode()
                    break
                except UnicodeDecodeError as error:
                    yield run[: error.start] + _REPLACEMENT
                    run = run[error.start + 1 :]
            yield run


def _in_tasks(
    rows: DataFrame, model_path: str, work: Callable[[Coder, list], list[tuple]], columns: list[str], out: str, types: tuple
) -> DataFrame:
    """A row out for each row in: a function of a task's coder gives the columns after the id for a slice of values."""
    spark = rows.sparkSession
    ship_package(spark)
    vocabulary = spark.sparkContext.broadcast(read_model(model_path))
    schema = pa.schema(list(zip([part.split()[0] for part in out.split(", ")], types)))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary.value)

        def pack(ids: list, values: list) -> pa.RecordBatch:
            made = zip(*[(i, *found) for i, found in zip(ids, work(coder, values))])
            return pa.record_batch([pa.array(c, t) for c, t in zip(made, types)], schema)

        for batch in batches:
            ids, values, size = [], [], 0
            for i, value in zip(batch.column(0), batch.column(1)):
                ids.append(i.as_py())
                values.append(value.as_py())
                size += len(values[-1] or "")
                if size > _SLICE:
                    yield pack(ids, values)
                    ids, values, size = [], [], 0
            if ids:
                yield pack(ids, values)
        del coder
        release_memory()

    return rows.select(F.col(columns[0]).cast("long").alias(columns[0]), columns[1]).mapInArrow(code, out)


def _read(ids: bytes | None) -> np.ndarray:
    return np.frombuffer(ids or b"", "<u4")


def encoded(docs: DataFrame, model_path: str, begin: bool = True, end: bool = True) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit numbers) of docs' texts."""

    def work(coder: Coder, texts: list[str | None]) -> list[tuple]:
        return [(ids,) for ids in coder.encode_all(texts, begin, end)]

    return _in_tasks(docs, model_path, work, ["doc_id", "text"], "doc_id long, ids binary", (pa.int64(), pa.binary()))


def decoded(rows: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text of packed ids; null ids have an empty text."""

    def work(coder: Coder, packed: list[bytes | None]) -> list[tuple]:
        return [(coder.decode(_read(ids)),) for ids in packed]

    return _in_tasks(rows, model_path, work, ["doc_id", "ids"], "doc_id long, text string", (pa.int64(), pa.string()))


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """Columns of CODED: the ids with begin and end, and the text decoded from them, in one Python step."""

    def work(coder: Coder, texts: list[str | None]) -> list[tuple]:
        return [(ids, len(ids) // 4, coder.decode(_read(ids))) for ids in coder.encode_all(texts)]

    types = (pa.int64(), pa.binary(), pa.int64(), pa.string())
    return _in_tasks(docs, model_path, work, ["doc_id", "text"], CODED, types)
