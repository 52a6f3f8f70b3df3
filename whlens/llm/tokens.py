"""Whole texts to token ids with a public tokenizer, many words at a time."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from whlens.llm.common import arrow_schema, text_batches

END_ID = 2
#: Words whose ids a process remembers, the longest of them, and the length up to
#: which they stay when there are too many; the ids of all of them.
KNOWN_WORDS, KNOWN_LENGTH, KEPT_LENGTH, FLAT_IDS = 900_000, 48, 8, 1 << 23
#: Bytes of text encoded at a time (one text at least).
SLICE_BYTES = 1 << 22
#: A word of plain Latin letters (composed ones of Latin-1 too), with marks after it.
PLAIN = "^(?P<stem>[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)(?P<marks>[!-/:-@\\[-`{-~]*)$"
SMALL = "^[a-z\u00DF-\u00F6\u00F8-\u00FF]+$"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()  # to_pylist makes a scalar of each value


class WordEncoder:
    """Encodes texts with a tokenizer whose tokens never span white space.

    ``word_bpe_49k`` splits its input at white space and between letters and marks
    before the merges, so a text's ids are those of its space-separated words, one
    after the other, and a plain word's those of its letters without case and of its
    marks. Arrow finds the distinct words of many texts and takes them apart; each part
    is encoded by the library once and then looked up: plain letters by the library's
    model itself, all else by the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one of many
        self.tokenizer = Tokenizer.from_file(path)
        self.stems = Tokenizer(self.tokenizer.model)
        self.stems.pre_tokenizer = CharDelimiterSplit(" ")
        vocabulary = self.tokenizer.get_vocab()
        suffix = self.tokenizer.model.end_of_word_suffix
        self.is_last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        to_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = [(chr(c), to_bytes.pre_tokenize_str(chr(c))[0][0]) for c in range(0xDF, 0x100)]
        self.forget()

    def _keep(self, words: dict[str, int]) -> None:
        """Remember only these words (each with its place so far)."""
        if words:
            at = np.fromiter(words.values(), np.int64, len(words))
            sizes = self.sizes[at]
            self.flat = _gather(self.flat, self.starts, sizes, at)
            self.known = dict(zip(words, range(len(words))))
        else:
            sizes, self.flat, self.known = np.zeros(1, np.int64), np.zeros(0, np.uint32), {"": 0}
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.places, self.ids = len(sizes), len(self.flat)  # in use: the arrays have room for more

    def forget(self) -> None:
        """Give back the memory of all remembered words."""
        self._keep({})

    def _add(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        """Remember words by the sizes of their ids, which follow each other."""
        self.known.update(zip(words, range(self.places, self.places + len(words))))
        self.starts = _append(self.starts, self.places, self.ids + np.cumsum(sizes) - sizes)
        self.sizes = _append(self.sizes, self.places, sizes)
        self.flat = _append(self.flat, self.ids, ids)
        self.places, self.ids = self.places + len(words), self.ids + len(ids)

    def _add_stems(self, stems: list[str]) -> None:
        """Words of small letters only, by the library's model alone: all in one call, a
        word's last id is one with the model's end of a word."""
        text = " ".join(stems)
        if not text.isascii():
            for letter, as_bytes in self.bytes:
                text = text.replace(letter, as_bytes)
        ids = np.array(self.stems.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.is_last[ids]) + 1
        if len(ends) == len(stems) and ends[-1] == len(ids):
            self._add(stems, np.diff(ends, prepend=0), ids)
        else:  # a model without such ends
            self._add_whole(stems)

    def _add_whole(self, words: list[str]) -> None:
        coded = [c.ids for c in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        self._add(words, sizes, np.fromiter(chain.from_iterable(coded), np.uint32, sizes.sum()))

    def _learn(self, words: pa.Array) -> None:
        """Remember these words: small plain letters, or any others as they are."""
        small = pc.match_substring_regex(words, SMALL)
        for some, add in ((small, self._add_stems), (pc.invert(small), self._add_whole)):
            if names := _strings(words.filter(some)):
                add(names)

    def _look_up(self, columns: list[pa.Array]) -> np.ndarray:
        """The places of these columns' words, one column beside the other."""
        coded = [c.dictionary_encode() for c in columns]
        words = [_strings(c.dictionary) for c in coded]
        at = [self._places(w) for w in words]
        missing = sum(np.count_nonzero(a < 0) for a in at)
        if len(self.known) + missing > KNOWN_WORDS or self.ids > FLAT_IDS:
            few = {w: k for w, k in self.known.items() if len(w) <= KEPT_LENGTH}
            self._keep(few if len(few) < KNOWN_WORDS // 2 else {})
            at = [self._places(w) for w in words]
        long = []
        for k, column in enumerate(coded):
            new = np.flatnonzero(self._places(words[k]) < 0 if k else at[k] < 0)  # the columns may share some
            if len(new):
                self._learn(column.dictionary.take(pa.array(new)))
                long += [words[k][i] for i in new.tolist() if len(words[k][i]) > KNOWN_LENGTH]
            missing = np.flatnonzero(at[k] < 0)
            at[k][missing] = [self.known[words[k][i]] for i in missing.tolist()]
        for w in long:  # not worth remembering
            del self.known[w]
        return np.stack([a[c.indices.to_numpy()] for a, c in zip(at, coded)], axis=1)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of the whole text (null: empty) with the end id."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        ids, ends = self.encode_column(pa.array(texts, pa.string()))
        return np.split(ids, ends[:-1]) if len(ends) else []

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, and where each text's ids end."""
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        found = pc.extract_regex(words, PLAIN)
        stems = pc.if_else(found.is_valid(), pc.utf8_lower(found.field("stem")), words)
        marks = pc.if_else(found.is_valid(), found.field("marks"), "")
        parts = self._look_up([stems, marks])
        sizes = self.sizes[parts]
        ids = _gather(self.flat, self.starts, sizes.ravel(), parts.ravel())
        sizes = sizes.sum(1)
        at = coded.indices.to_numpy()
        starts, sizes = np.cumsum(sizes) - sizes, sizes[at]
        last = np.cumsum(pc.list_value_length(split).to_numpy()) - 1  # every text has a word, if an empty one
        ends = np.cumsum(sizes)[last]
        return np.insert(_gather(ids, starts, sizes, at), ends, END_ID), ends + np.arange(1, len(ends) + 1)

    def _places(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))


def _gather(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` at these places, ``sizes[i]`` values from ``starts[at[i]]``, one after the other."""
    ends = np.cumsum(sizes)
    return ids[np.repeat(starts[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


def _append(array: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``array`` with ``more`` after its first ``used`` values; where it is full, twice as long."""
    if used + len(more) > len(array):
        array = np.concatenate([array[:used], np.empty(used + len(more), array.dtype)])
    array[used:used + len(more)] = more
    return array


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The task process's own encoder; it is kept between tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def text_slices(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[pa.RecordBatch]:
    """Cut incoming batches into rows of about ``SLICE_BYTES`` of text together."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(), dtype=np.int64)
        cuts = np.flatnonzero(np.diff(size // SLICE_BYTES, prepend=0)).tolist()
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if b > a:
                yield batch.slice(a, b - a)


def token_table(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id long, n_tokens long, ids binary): ids of each whole text (null:
    empty) and the end id, as little-endian unsigned 16-bit integers (the
    vocabulary has fewer than 65,536 ids)."""
    text_batches(docs.sparkSession)
    ddl = "doc_id long, n_tokens long, ids binary"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in text_slices(batches):
            ids, ends = coder.encode_column(batch.column(1))
            offsets = np.concatenate([[0], 2 * ends]).astype(np.int32)
            coded = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u2"))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends, prepend=0)), coded], schema=schema)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string")).mapInArrow(run, ddl)
