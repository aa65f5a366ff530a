"""Exact encoding of whole Arrow columns of text, inside Spark's Python workers.

A text is cut at ASCII white space, which no token spans; every distinct chunk of a batch is encoded once, and a worker
remembers chunks from batch to batch. The memory bounds below only decide when a worker forgets, never what it returns.
"""

from __future__ import annotations

import gc
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from assaylake.llm.vocabulary import vocabulary

#: Chunks and words that a worker remembers before it starts anew.
CHUNKS_KEPT, WORDS_KEPT = 600_000, 300_000
#: Bytes of text encoded at a time; a longer text is a step of its own.
STEP_BYTES = 2 << 20
#: Texts in which lower-casing A-Z first could change the result: a capital under a combining mark, a special string.
_AS_IT_IS = r"[A-Z]\p{M}|<\|"


def steps(column: pa.Array, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of texts with at most `most` bytes, or one text."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, upto - at
        at = upto


@contextmanager
def _uncollected() -> Iterator[None]:
    """Without the search for cycles, which would go through millions of lists of numbers again and again and find none."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def _known(places: dict, keys: list) -> tuple[np.ndarray, list]:
    """Place of each of the distinct keys, and those of them that had none and were added at the end."""
    found = np.fromiter(map(places.get, keys, repeat(-1)), np.int64, len(keys))
    missing = found < 0
    new = list(compress(keys, missing.tolist()))
    found[missing] = np.arange(len(places), len(places) + len(new))
    places.update(zip(new, range(len(places), len(places) + len(new)), strict=True))
    return found, new


class Runs:
    """Runs of ids by place, in arrays: a list of numbers would take ten times the memory."""

    def __init__(self) -> None:
        self.flat, self.starts, self.counts = array("I"), array("Q"), array("I")

    def __len__(self) -> int:
        return len(self.counts)

    def add(self, ids: array | np.ndarray, counts: np.ndarray) -> None:
        starts = len(self.flat) + np.cumsum(counts) - counts
        self.flat.frombytes(memoryview(ids).cast("B") if len(ids) else b"")
        self.starts.frombytes(starts.astype(np.uint64).tobytes())
        self.counts.frombytes(counts.astype(np.uint32).tobytes())

    def sizes(self, places: np.ndarray) -> np.ndarray:
        return np.asarray(self.counts)[places].astype(np.int64)

    def at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the runs at these places one after the other, and the size of each."""
        counts = self.sizes(places)
        ends = np.cumsum(counts)
        where = np.repeat(np.asarray(self.starts)[places].astype(np.int64) - ends + counts, counts)
        where += np.arange(len(where))
        return np.asarray(self.flat)[where], counts


class Encoder:
    """Encodes columns; `trie` chooses between the trie traversal and the library's merges for words not yet known."""

    def __init__(self, path: str, trie: bool = False):
        self.vocabulary, self.trie = vocabulary(path), trie
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.chunks = Runs()
        self._forget_words()

    def _forget_words(self) -> None:
        self.words: dict[str | int, int] = {}
        self.of_words = Runs()

    def _places(self, chunks: list[str]) -> np.ndarray:
        """Place of each of the distinct chunks among those remembered; new ones are encoded and added."""
        if len(self.place) > CHUNKS_KEPT:
            self._forget()
        elif len(self.words) > WORDS_KEPT:
            self._forget_words()
        places, new = _known(self.place, chunks)
        if len(new):
            with _uncollected():
                cut = self.vocabulary.cut_chunks(new)
                pieces = list(chain.from_iterable(cut))
                sizes = np.fromiter(map(len, cut), np.int64, len(cut))
            ids, counts = self.of_words.at(self._words(pieces))
            ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(sizes)]
            self.chunks.add(ids, np.diff(ends, prepend=0))
        return places

    def _words(self, pieces: list[str | int]) -> np.ndarray:
        """Place of each piece among the words remembered; new ones are encoded and added."""
        slots = np.fromiter(map(self.words.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = slots < 0
        if missing.any():
            asked = list(compress(pieces, missing.tolist()))
            _, new = _known(self.words, list(dict.fromkeys(asked)))
            with _uncollected():
                coded = self.vocabulary.encode_pieces(new, self.trie)
                self.of_words.add(array("I", chain.from_iterable(coded)), np.fromiter(map(len, coded), np.int64, len(coded)))
            slots[missing] = np.fromiter(map(self.words.__getitem__, asked), np.int64, len(asked))
        return slots

    def _cut(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of all chunks of the column, and how many each text has."""
        column = pc.fill_null(column, "")
        column = pc.if_else(pc.match_substring_regex(column, _AS_IT_IS), column, pc.ascii_lower(column))
        cut = pc.ascii_split_whitespace(column)
        coded = cut.flatten().dictionary_encode()
        places = self._places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy(zero_copy_only=False)]
        return places, pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)

    def count(self, column: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        places, texts = self._cut(column)
        before = np.concatenate([[0], np.cumsum(self.chunks.sizes(places))])
        ends = np.cumsum(texts)
        return before[ends] - before[ends - texts]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column one after the other, and the places between its texts (one more than texts)."""
        places, texts = self._cut(column)
        ids, counts = self.chunks.at(places)
        before = np.concatenate([[0], np.cumsum(counts)])
        return ids, before[np.concatenate([[0], np.cumsum(texts)])]


@lru_cache(maxsize=2)
def encoder(path: str, trie: bool = False) -> Encoder:
    """One per Python worker and kind, so that it outlives a task."""
    return Encoder(path, trie)


def binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Slices of data between neighbouring places as a binary column."""
    data = np.ascontiguousarray(data)
    places = (ends * data.itemsize).astype(np.int64)
    big = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(places), pa.py_buffer(data)])
    return big.cast(pa.binary())
