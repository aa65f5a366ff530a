"""Hashes of words and word shingles over whole Arrow columns of text, inside Spark's Python workers."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Odd factors of the words of a shingle, and what sets shorter sequences apart.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)


def spread(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A one-to-one mix of 64-bit numbers, another one for every salt."""
    x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (ASCII lower case, cut at ASCII white space), and the number of words of each text."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = cut.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    names = coded.dictionary.to_numpy(zero_copy_only=False)
    hashed = pd.util.hash_array(names, categorize=False) if len(names) else np.zeros(0, np.uint64)
    there = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    per = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), per)[there[codes]] if len(codes) else np.zeros(0, np.int64)
    hashes = hashed[codes][there[codes]] if len(codes) else np.zeros(0, np.uint64)
    return hashes, np.bincount(owner, minlength=len(texts))


def shingles(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The sorted set of hashes of every text's shingles of `width` words, one text after the other, and the sizes of the
    sets. A text with fewer words has the whole sequence as its one shingle; without words it has none."""
    words, sizes = word_hashes(texts)
    n, ends = len(words), np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(n)
    whole = ends[owner] - at >= width
    begin = np.flatnonzero(whole)
    hashed = np.zeros(len(begin), np.uint64)
    for k in range(width):
        hashed += words[begin + k] * np.uint64(FACTORS[k])
    hashes, owners = [spread(hashed)], [owner[begin]]
    for m in range(1, width):
        short = np.flatnonzero(sizes == m)
        begin = ends[short] - m
        hashed = np.zeros(len(short), np.uint64)
        for k in range(m):
            hashed += words[begin + k] * np.uint64(FACTORS[k])
        hashes.append(spread(hashed, salt=m))
        owners.append(short)
    flat, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.lexsort((flat, owner))
    flat, owner = flat[order], owner[order]
    fresh = np.ones(len(flat), bool)
    fresh[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
    return flat[fresh], np.bincount(owner[fresh], minlength=len(sizes))
