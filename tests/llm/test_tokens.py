"""Token counts, codec, stored ids and packing against the tokenizers library, over odd rows and the smallest test data."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaylake.llm import bpe_codec, packing, rans_store, registered, token_counts
from assaylake.llm.encoding import Encoder
from assaylake.llm.vocabulary import version, vocabulary
from assaylake.session import fresh_path
from tests.llm.conftest import ROWS


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_words_of_the_trie_match_the_library(vocabulary_path, library):
    v, rng = vocabulary(vocabulary_path), random.Random(5)
    parts = ["a", "ab", "the", "ing", "é", "ß", "İ", "J̌", "1", "'s", "'", "!!", "=", "-_", "<|endoftext|>", "<|", "Σς", "日", "\x1c", "\x85", "</w>"]
    chunks = ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(5000)]
    chunks += [c * k for c in ("a", "=", "ha", "-_", "0") for k in range(1, 60)]
    for trie in (True, False):
        assert v.encode_chunks(chunks, trie=trie) == [e.ids for e in library.encode_batch(chunks, add_special_tokens=False)]


def test_plain_words_are_not_cut_and_not_copied(vocabulary_path, library, monkeypatch):
    v = vocabulary(vocabulary_path)
    expected = [e.ids for e in library.encode_batch(["plain", "Words", "plain"], add_special_tokens=False)]
    monkeypatch.setattr(v, "pieces", lambda chunk: pytest.fail(f"{chunk} was cut"))
    coded = v.encode_chunks(["plain", "Words", "plain"])
    assert coded == expected and coded[0] is coded[2]


def test_a_worker_that_collects_no_garbage_is_left_so(vocabulary_path, ids_of):
    import gc

    import pyarrow as pa

    texts = ["plain words, (and others) plain", "", "a1 b2 straße"]
    for on in (True, False):
        (gc.enable if on else gc.disable)()
        try:
            own = Encoder(vocabulary_path)
            for _ in range(2):  # new chunks, then remembered ones
                ids, ends = own.encode(pa.array(texts))
                assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [list(ids_of(t)) for t in texts]
            assert gc.isenabled() is on
        finally:
            gc.enable()


def test_remembered_chunks_take_little_memory(vocabulary_path, ids_of):
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(7)
    words = sorted({"".join(rng.choices("abcdefghij", k=9)) for _ in range(20_000)})
    texts = [" ".join(w + "," for w in words[k : k + 100]) for k in range(0, len(words), 100)]
    own = Encoder(vocabulary_path)
    own.encode(pa.array(texts[:2]))
    tracemalloc.start()
    try:
        ids, ends = own.encode(pa.array(texts))
        held = tracemalloc.get_traced_memory()[0] - ids.nbytes
    finally:
        tracemalloc.stop()
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [list(ids_of(t)) for t in texts]
    assert held < 400 * len(words), held / len(words)


def test_shared_prefixes_are_walked_once(vocabulary_path):
    v = vocabulary(vocabulary_path)
    words = {"inter", "internal", "international", "internationally", "intern", "i"}
    assert v.encode_words(words) == {w: v.encode_words({w})[w] for w in words} == v.tokenize_words(words)


def test_counts_of_odd_rows(spark, odd, vocabulary_path, ids_of):
    cache = fresh_path(spark, "test-cache")
    got = token_counts.count_tokens(odd, cache, vocabulary_path).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == Counter(
        (i, len((t or "").encode()), len(ids_of(t))) for i, t, _ in ROWS
    )


def test_cache_holds_each_content_once_and_is_used(spark, odd, vocabulary_path):
    cache = fresh_path(spark, "test-cache")
    token_counts.count_tokens(odd, cache, vocabulary_path)
    stored = spark.read.parquet(cache)
    assert stored.count() == stored.select("digest").distinct().count() == odd.select(token_counts.content_digest(F.col("text"))).distinct().count()
    wrong = stored.withColumn("n_tokens", F.lit(77).cast("long"))
    other = fresh_path(spark, "test-cache")
    wrong.write.parquet(other)
    got = token_counts.count_tokens(odd, other, vocabulary_path)
    assert {r["n_tokens"] for r in got.collect()} == {77}
    assert spark.read.parquet(other).count() == stored.count()
    assert [r["tokenizer"] for r in stored.select("tokenizer").distinct().collect()] == [version(vocabulary_path)]


def test_codec_of_odd_rows(odd, vocabulary_path, library, ids_of):
    coded = bpe_codec.encode_documents(odd, vocabulary_path)
    got = Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in coded.collect())
    want = Counter((i, len(ids_of(t)), packed(ids_of(t)), library.decode(ids_of(t), skip_special_tokens=False)) for i, t, _ in ROWS)
    assert got == want
    again = bpe_codec.decode_documents(coded, vocabulary_path).collect()
    assert Counter((r["doc_id"], r["decoded"]) for r in again) == Counter((i, d) for i, _, _, d in want.elements())


def test_registered_counts_and_codec(spark, sf_dir, sample, library, ids_of):
    counts = {r["doc_id"]: r for r in registered.op1_token_counts(spark, sf_dir).collect()}
    coded = {r["doc_id"]: r for r in registered.op2_bpe_codec(spark, sf_dir).collect()}
    for d in sample:
        ids = ids_of(d["text"])
        c, x = counts[d["doc_id"]], coded[d["doc_id"]]
        assert (c["n_tokens"], c["over_limit"]) == (len(ids), len(ids) > 2048) and x["n_tokens"] == len(ids)
        assert x["ids_sha256"] == hashlib.sha256(packed(ids)).hexdigest()
        assert x["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 4000, 70_000])
def test_blocks_round_trip_from_every_checkpoint(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 5000)
    table = rans_store.quantise(np.bincount(ids, minlength=6000))
    payload = rans_store.encode_block(ids, table, every=4)
    assert (rans_store.decode_block(payload, table) == ids).all()
    for first in range(0, n, max(1, n // 23)):
        assert (rans_store.decode_block(payload, table, first, first + 9) == ids[first : first + 9]).all()


def test_a_damaged_block_is_noticed():
    ids = np.arange(500) % 7
    table = rans_store.quantise(np.bincount(ids))
    payload = bytearray(rans_store.encode_block(ids, table))
    payload[len(payload) // 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans_store.decode_block(bytes(payload), table)
    with pytest.raises(ValueError, match="not in the table"):
        rans_store.encode_block(np.array([1, 2]), rans_store.quantise([5, 5, 0, 1]))


def test_stored_odd_rows(spark, odd, vocabulary_path, ids_of):
    folder = fresh_path(spark, "test-ids")
    rans_store.write_corpus(odd, folder, vocabulary_path, block_ids=50)
    got = rans_store.with_starts(rans_store.read_corpus(spark, folder), folder).collect()
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in got) == Counter((i, packed([*ids_of(t), 1])) for i, t, _ in ROWS)
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_registered_store(spark, sf_dir, sample, ids_of):
    got = {r["doc_id"]: r for r in registered.op5_rans_store(spark, sf_dir).collect()}
    at = 0
    for d in sorted(sample, key=lambda d: d["doc_id"]):
        ids = [*ids_of(d["text"]), 1]
        r = got[d["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(packed(ids)))
        at += len(ids)


def check_places(rows, want, capacity):
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == Counter(want)
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def pieces_of(docs, ids_of, capacity):
    for key, text in docs:
        ids = [*ids_of(text), 0]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            yield key, k // capacity, k, len(part), zlib.crc32(packed(part))


def test_packed_odd_rows(odd, vocabulary_path, ids_of):
    got = packing.pack(odd, vocabulary_path, 32).collect()
    want = list(pieces_of([(i, t) for i, t, _ in ROWS], ids_of, 32))
    sizes = sorted((w[3] for w in want), reverse=True)
    assert check_places(got, want, 32) == sizes.count(32) + exact_bins(sizes[sizes.count(32) :], 32)


def test_packed_sequences_hold_the_ids(odd, vocabulary_path, ids_of):
    docs = odd.where("doc_id in (1, 3, 7, 10, 14)")
    pieces = packing.cut_pieces(docs, vocabulary_path, 16, with_ids=True)
    rows = packing.sequences(pieces, packing.place_pieces(pieces, 16)).collect()
    texts = {i: t for i, t, _ in ROWS}
    want = [x for i in (1, 3, 7, 10, 14) for x in [*ids_of(texts[i]), 0]]
    assert Counter(np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows]).tolist()) == Counter(want)
    assert all(len(r["ids"]) <= 64 for r in rows)


def test_registered_packing(spark, sf_dir, sample, ids_of):
    got = registered.op6_bin_completion(spark, sf_dir).collect()
    want = list(pieces_of([(d["doc_id"], d["text"]) for d in sample], ids_of, 2048))
    counts = np.bincount([w[3] for w in want], minlength=2049)
    assert packing.waste_bound(counts, 2048) <= check_places(got, want, 2048) <= packing.waste_bound(counts, 2048) + 1


def exact_bins(sizes, capacity):
    """Fewest bins by trying everything."""
    best = [len(sizes)]

    def put(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(sizes):
            best[0] = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms)}.values():
            if rooms[j] >= sizes[k]:
                put(k + 1, [*rooms[:j], rooms[j] - sizes[k], *rooms[j + 1 :]])
        put(k + 1, [*rooms, capacity - sizes[k]])

    put(0, [])
    return best[0]


def test_plans_against_exhaustive_search():
    rng = np.random.default_rng(3)
    for _ in range(60):
        sizes = sorted(rng.integers(3, 19, rng.integers(1, 10)).tolist(), reverse=True)
        counts = np.bincount(sizes, minlength=21)
        steps = packing.plan(counts, 20)
        used = np.zeros(21, int)
        for times, filling in steps:
            assert sum(filling) <= 20
            for x in filling:
                used[x] += times
        assert (used == counts).all()
        fewest = exact_bins(sizes, 20)
        assert packing.waste_bound(counts, 20) <= fewest <= sum(t for t, _ in steps) <= fewest + (fewest > 3)


def test_completion_beats_best_fit():
    counts = np.bincount([51, 51, 27, 27, 26, 26, 23, 23, 46], minlength=101)
    assert sum(t for t, _ in packing.plan(counts, 100)) == exact_bins([51, 51, 46, 27, 27, 26, 26, 23, 23], 100) == 3


def test_empty_table(spark, empty, vocabulary_path):
    assert token_counts.count_tokens(empty, fresh_path(spark, "test-cache"), vocabulary_path).collect() == []
    assert bpe_codec.encode_documents(empty, vocabulary_path).collect() == []
    folder = fresh_path(spark, "test-ids")
    rans_store.write_corpus(empty, folder, vocabulary_path)
    assert rans_store.with_starts(rans_store.read_corpus(spark, folder), folder).collect() == []
    assert packing.pack(empty, vocabulary_path, 2048).collect() == []
