"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are the powers of two of its length's binary form, the largest
first, with as many pieces of the largest size as needed. Each piece is a sequence of its own: no sequence crosses
documents and none needs padding. Equal lengths form a bucket (the base-2 logarithm of the length), from which a
trainer draws batches of one shape.

Ids come from a public tokenizer, whose file is a parameter, without special tokens, then an end id. A text is
split at blanks and line feeds, which that tokenizer drops and never joins across; it lower-cases, so chunks that
differ in case are one. Texts are split together, about _AT_ONCE characters at a time; of each distinct word of these the
ids are asked for once, many words at a time. Words of Latin letters, which the file's normalizer and regular expression
leave as they are, go to its model without these. Other chunks are kept, as long as the task, in a dictionary of a
bounded number of bytes.

Defined cases: a null or empty text has the end id alone, one piece of length 1; repeated rows are packed each on
its own; a text of any length is cut whole; an empty table gives no rows; only doc_id and text are read, so other
columns, whatever their names, play no part. Sequence ids are unique within a result; they follow the partitions.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.shared import each, release_memory, ship_package

MAX_LENGTH = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
#: Bytes that kept chunks may take, about, in each of two generations, and characters of the longest one kept.
_KEPT_BYTES = 10_000_000
_KEPT_CHUNK_CHARS = 64
_ENTRY = 400
#: Characters of texts that are split together, about.
_AT_ONCE = 1 << 22
#: Words that are put to the tokenizer together.
_WORDS = 128
#: Bytes of ids after which a task hands on its pieces.
_HAND_ON = 4_000_000
#: Marks that form a piece of their own after a run of letters, whatever follows the blank.
_MARKS = ".,!*%&#$;:?"
#: Letters before this one (Latin) that are in lower case are in composed form and stay as they are.
_PLAIN = "\u0250"
#: A word of such letters, and marks after it.
_LETTERED = r"^[a-z\x{aa}\x{b5}\x{ba}\x{df}-\x{f6}\x{f8}-\x{24f}]+[.,!*%&#$;:?]*$"
#: What a tokenizer does before its model; such a one leaves words of plain letters whole.
_STEPS = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)

PIECES = "doc_id long, start long, length long, bucket int, ids binary, doc_tokens long"


class _Chunks:
    """Ids of lower-cased chunks. Words of letters are put to the tokenizer together."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = self.words = Tokenizer.from_file(path)
        steps = (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)
        if tuple(json.loads(step.__getstate__()) if step else None for step in steps) == _STEPS:
            self.words = Tokenizer(self.tokenizer.model)
            letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), letters])
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.ids: dict[str, np.ndarray] = {}
        self.older: dict[str, np.ndarray] = {}
        self.size = 0

    def ask(self, text: str, words: bool = False) -> np.ndarray:
        """Ids of a text; `words`: it is lower-cased words of letters with blanks between."""
        if not text:
            return np.zeros(0, "<u4")
        tokenizer = self.words if words and (text.isascii() or max(text) < _PLAIN) else self.tokenizer
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def kept(self, chunk: str) -> np.ndarray:
        """Ids of a chunk that isn't of letters, asked for once while it is kept."""
        found = self.ids.get(chunk)
        if found is None:
            found = self.older.get(chunk)
            found = self.ask(chunk) if found is None else found
            if len(chunk) <= _KEPT_CHUNK_CHARS:
                if self.size > _KEPT_BYTES:
                    self.ids, self.older, self.size = {}, self.ids, 0
                self.ids[chunk] = found
                self.size += _ENTRY
        return found

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of letters, one after another, and how many each word has."""
        made, ends, size = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)], 0
        for at in range(0, len(words), _WORDS):
            some = words[at : at + _WORDS]
            found = self.ask(" ".join(some), words=True)
            end = np.flatnonzero(self.ends_word[found]) + 1
            if len(end) != len(some):
                raise ValueError("the tokenizer doesn't mark the ends of words")
            made.append(found)
            ends.append(end + size)
            size += len(found)
        return np.concatenate(made), np.diff(np.concatenate(ends), prepend=0)

    def of_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct chunks, one after another, and how many each chunk has.

        Of a word of letters and marks after it, both are looked up by themselves; other chunks are put to the tokenizer whole."""
        lettered = pc.match_substring_regex(chunks, _LETTERED).to_numpy(zero_copy_only=False)
        whole = []
        for place in np.flatnonzero(~lettered).tolist():
            chunk = chunks[place].as_py()
            if chunk.rstrip(_MARKS).isalpha():
                lettered[place] = True
            else:
                whole.append((place, self.kept(chunk)))
        places = np.flatnonzero(lettered)
        some = chunks.take(pa.array(places))
        words = pc.utf8_rtrim(some, characters=_MARKS).dictionary_encode()
        marks = pc.replace_substring_regex(some, pattern=f"^[^{_MARKS}]*", replacement="").dictionary_encode()
        ids, lengths = self.of_words(words.dictionary.to_pylist())
        further = [self.kept(m) for m in marks.dictionary.to_pylist()] + [found for _, found in whole]
        pool = np.concatenate([ids, *further])
        lengths = np.concatenate([lengths, np.array(list(map(len, further)), np.int64)])
        # Two parts of each chunk, by their place among `lengths`: its word or all of it, its marks.
        parts = np.full((len(chunks), 2), -1)
        parts[places, 0] = words.indices.to_numpy()
        parts[places, 1] = marks.indices.to_numpy() + len(words.dictionary)
        parts[[place for place, _ in whole], 0] = np.arange(len(lengths) - len(whole), len(lengths))
        starts, lengths = np.append(np.cumsum(lengths) - lengths, 0), np.append(lengths, 0)
        return _gathered(pool, starts[parts.ravel()], lengths[parts.ravel()]), lengths[parts].sum(axis=1)


def _gathered(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids of runs, each given by its start and its length, one run after another."""
    ends = np.cumsum(lengths)
    return ids[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


def ids_of_texts(texts: list[str | None], chunks: _Chunks) -> Iterator[bytes]:
    """The ids of each text as little-endian unsigned 32-bit numbers, without the end id.

    A text whose lower case depends on neighbours, that isn't in composed form, or that may hold the name of a
    special token is put to the tokenizer whole. The others are split together; each distinct chunk is looked up once.
    """
    whole: dict[int, bytes] = {}
    split = []
    for place, text in enumerate(texts):
        if text and ("<|" in text or "\u03a3" in text or "\u0130" in text or not is_normalized("NFC", text)):
            whole[place], text = chunks.ask(text).tobytes(), None
        split.append(text.lower().replace("\n", " ") if text else "")
    parts = pc.split_pattern(pa.array(split, pa.large_string()), " ")
    distinct = parts.values.dictionary_encode()
    ids, lengths = chunks.of_chunks(distinct.dictionary)
    places = distinct.indices.to_numpy()
    made = _gathered(ids, (np.cumsum(lengths) - lengths)[places], lengths[places])
    bounds = np.concatenate([[0], np.cumsum(lengths[places])])[parts.offsets.to_numpy()].tolist()
    for place, (begin, end) in enumerate(zip(bounds, bounds[1:])):
        yield whole[place] if place in whole else made[begin:end].tobytes()


def token_ids(text: str | None, chunks: _Chunks) -> bytes:
    """The ids of one text."""
    return next(ids_of_texts([text], chunks))


def _together(rows: Iterator[tuple[int | None, str | None]]) -> Iterator[list[tuple[int | None, str | None]]]:
    """The rows in runs of about _AT_ONCE characters; a longer text is in a run of its own or ends one."""
    run, size = [], 0
    for row in rows:
        run.append(row)
        size += len(row[1] or "") + 1
        if size > _AT_ONCE:
            yield run
            run, size = [], 0
    if run:
        yield run


def binary_pieces(length: int, most: int = MAX_LENGTH) -> Iterator[tuple[int, int]]:
    """(start, size) of the pieces of a document of `length` ids; `most` is a power of two."""
    start = 0
    while start < length:
        size = min(most, 1 << ((length - start).bit_length() - 1))
        yield start, size
        start += size


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, most: int = MAX_LENGTH) -> DataFrame:
    """Columns of PIECES; ids are little-endian unsigned 32-bit numbers. Nothing is shuffled."""
    if most < 1 or most & (most - 1):
        raise ValueError("the longest piece must be a power of two")
    ship_package(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()
    fields = ("doc_id", "start", "length", "bucket", "ids", "doc_tokens")
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
    schema = pa.schema(list(zip(fields, types)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _Chunks(tokenizer_path)
        for batch in batches:
            rows: list[list] = [[] for _ in fields]
            size = 0
            for run in _together(zip(each(batch.column(0)), each(batch.column(1)))):
                for (doc_id, _), ids in zip(run, ids_of_texts([text for _, text in run], chunks)):
                    ids += end
                    total = len(ids) // 4
                    for start, length in binary_pieces(total, most):
                        piece = ids[4 * start : 4 * (start + length)]
                        for column, value in zip(rows, (doc_id, start, length, length.bit_length() - 1, piece, total)):
                            column.append(value)
                    size += len(ids)
                    if size > _HAND_ON:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, types)], schema)
                        rows, size = [[] for _ in fields], 0
            yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, types)], schema)
        del chunks
        release_memory()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def sequences(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, most: int = MAX_LENGTH) -> DataFrame:
    """The pieces with sequence_id and offset: every piece fills a sequence of its bucket's length."""
    return (
        pieces(docs, tokenizer_path, end_id, most)
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    )
