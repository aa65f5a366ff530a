"""BPE encoding by traversal of a trie of distinct words, and decoding."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.encoding import binaries, encoder, steps
from assaylake.llm.vocabulary import vocabulary

#: Bytes of text that are encoded and handed back at a time.
STEP_BYTES = 4 << 20


@lru_cache(maxsize=2)
def _tokens(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every token's text followed by a space: all bytes, and each token's start and length."""
    texts = [t + b" " for t in vocabulary(path).token_bytes()]
    lengths = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths) - lengths, lengths


def decode_ids(ids: np.ndarray, places: np.ndarray, path: str) -> pa.Array:
    """Texts of runs of ids: tokens joined by a space, as a vocabulary without a decoder of its own is decoded."""
    data, starts, lengths = _tokens(path)
    sizes = lengths[ids]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    out = data[np.arange(ends[-1]) - np.repeat(ends[:-1] - starts[ids], sizes)] if len(ids) else data[:0]
    # a run's last space is not part of its text
    keep = np.ones(len(out), bool)
    some = places[1:] > places[:-1]
    keep[ends[places[1:][some]] - 1] = False
    return binaries(out[keep], np.concatenate([[0], np.cumsum(np.diff(ends[places]) - some)])).cast(pa.string())


def _encode(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, trie=True)
        for batch in batches:
            keys, texts = batch.column("doc_id"), batch.column("text")
            for at, n in steps(texts, STEP_BYTES):
                ids, places = own.encode(texts.slice(at, n))
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(at, n), pa.array(np.diff(places)), binaries(ids, places), decode_ids(ids, places, path)],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    return encode


def encode_documents(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the text decoded from the ids.

    Null and empty texts give no ids and an empty text. Every row is kept as it comes, with a null or repeated id too;
    other columns are ignored. Nothing is shuffled: each task inserts the distinct words of a few MB of text, without
    those it still knows, into a trie and walks it once.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_encode(vocabulary_path), f"doc_id {kind}, n_tokens bigint, ids binary, decoded string")


def _decode(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x or b"", "<u4") for x in batch.column("ids").to_pylist()]
            places = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
            text = decode_ids(np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int64), places, path)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), text], ["doc_id", "decoded"])

    return decode


def decode_documents(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """Texts of stored ids (columns doc_id and ids); null ids give an empty text."""
    rows = encoded.select("doc_id", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_decode(vocabulary_path), f"doc_id {kind}, decoded string")
