"""Cross-entropy difference: how much better a target model predicts a text than a background model does.

Both are word bigram models of the same order, smoothing and vocabulary, which is every word of the corpus (told apart by 32
bits of its hash): the target is counted over the rows marked as such, the background over all the others. The smoothing is a
Dirichlet prior around the model's own unigrams,

    p(word | before) = (c(before, word) + PRIOR * p(word)) / (c(before) + PRIOR),

whose loss is a sum of a term of the word, a term of the word before it and a term of the bigram. Every task counts the words
and bigrams of its rows and passes them on in blocks of sorted keys, one per bucket of keys; the buckets are merged and become
one table of terms (key, value), as large as the corpus makes it. A text is a bag of terms: those that are frequent in
the corpus are known to all tasks, a table of bounded size; all others are joined with the table. Values are whole millionths
of a bit, so sums don't depend on their order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from assaylake.llm.encoding import steps
from assaylake.llm.hashing import spread, word_hashes
from assaylake.llm.shipping import ship
from assaylake.session import forget, settle

#: Weight of the unigrams in a bigram's prediction, in words, and what is added to every unigram count.
PRIOR, ADDED = 256.0, 0.5
#: Bigrams seen less often in the whole corpus have no term of their own: both models predict them by their words.
LEAST = 2
#: At most so many terms are known to all tasks (12 bytes each), words in the join that prices bigrams, and target ids in the
#: join that marks the texts. All others are joined by a shuffle, with the same result.
KNOWN_TERMS, KNOWN_WORDS, KNOWN_IDS = 1 << 21, 1 << 16, 1 << 20
#: Parts of a bit in which values are kept.
UNIT = 1_000_000
#: What stands before a text's first word; bytes of text a worker takes at a time; distinct bigrams it keeps before it passes them on.
START, STEP, KEPT = np.uint64(1), 1 << 20, 1 << 20
#: While words are counted, a count in the background and one in the target share a number of 64 bits; words that are counted so.
HALF, HELD = 32, 1 << 29
#: Buckets of keys: so many a partition, as long as there are no more than BUCKETS in all. Entries that wait before they are merged.
BUCKETS_EACH, BUCKETS, MERGED = 8, 1 << 9, 1 << 18
#: Bits of the map of bigrams that have a term. It spares the others the join while it isn't full.
SLOTS = 1 << 27
WORD, BEFORE, BIGRAM = 0, 1, 2
#: Upper half of the keys of BEFORE terms; that of WORD terms is 0, that of bigrams their word's number, which is FIRST at least.
MARK, FIRST = np.uint64(1 << 32), np.uint64(4)


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of every word and of the word before it, below 2**32, and the number of words of each text."""
    words, sizes = word_hashes(texts)
    words = np.maximum(spread(words) >> np.uint64(32), FIRST)
    before = np.concatenate([[START], words[:-1]]) if len(words) else words
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = START
    return words, before, sizes


def _merged(key: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts (a row per key)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else order
    return key[first], np.add.reduceat(counts[order], first, axis=0) if len(key) else counts


def _packed(key: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences and their counts, byte planes apart, so that empty ones vanish."""
    steps_ = np.diff(key, prepend=np.uint64(0))
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(key), 8).T.tobytes() for c in (steps_, *counts.T)]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpacked(data: bytes, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(data, n * 8 * (width + 1), codec="zstd", asbytes=True), np.uint8).reshape(width + 1, 8, n)
    columns = [np.ascontiguousarray(plane.T).view(np.uint64).reshape(n) for plane in raw]
    return np.cumsum(columns[0], dtype=np.uint64), np.stack(columns[1:], axis=1).view(np.int64)


def _sides(counts: np.ndarray) -> np.ndarray:
    """Background and target of every count, beside each other."""
    halves = np.stack([counts & ((1 << HALF) - 1), counts >> HALF], axis=2)
    return halves.reshape(len(counts), -1)


def _blocks(kind: int, key: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    bucket = (spread(key, salt=3) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=buckets))
    full = [(b, order[begin:end]) for b, (begin, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if end > begin]
    return pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array([b for b, _ in full], pa.int32()),
            "kind": pa.array([kind] * len(full), pa.int8()),
            "n": pa.array([len(at) for _, at in full], pa.int64()),
            "block": pa.array([_packed(key[at], _sides(counts[at])) for _, at in full], pa.binary()),
        }
    )


def _count(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting = held = 0

        def merge() -> None:
            nonlocal waiting
            for kind, found in parts.items():
                found = [kept.pop(kind), *found] if kind in kept else found
                joined = [np.concatenate(both) for both in zip(*found, strict=True)]
                found.clear()
                kept[kind] = _merged(*joined)
            parts.clear()
            waiting = 0

        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            target = batch.column("target").to_numpy(zero_copy_only=False).astype(np.int64)
            for at, n in steps(texts, STEP):
                words, before, sizes = terms(texts.slice(at, n))
                one = np.repeat(np.left_shift(1, HALF * target[at : at + n]), sizes)
                none = np.zeros_like(one)
                # of a word: its count, then its count as the word before, in background and target each
                ones = np.concatenate([words, before]), np.stack([np.concatenate([one, none]), np.concatenate([none, one])], axis=1)
                for kind, found in ((WORD, ones), (BIGRAM, (words << np.uint64(32) | before, one[:, None]))):
                    parts.setdefault(kind, []).append(_merged(*found))
                waiting, held = waiting + len(parts[BIGRAM][-1][0]), held + len(words)
                # as many as are merged already, so that a key is merged a few times at most
                if waiting > max(MERGED, len(kept[BIGRAM][0]) // 2 if kept else 0) or held > HELD:
                    merge()
                    if len(kept[BIGRAM][0]) > KEPT or held > HELD:
                        yield from (_blocks(kind, *found, buckets) for kind, found in kept.items())
                        kept.clear()
                        held = 0
        merge()
        yield from (_blocks(kind, *found, buckets) for kind, found in kept.items())

    return count


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come sorted by bucket, so that a task holds the keys of one bucket at a time."""
    kept, parts, waiting, at_bucket = {}, {}, 0, None

    def merge() -> None:
        nonlocal waiting
        for kind, found in parts.items():
            found = [kept[kind], *found] if kind in kept else found
            kept[kind] = _merged(*(np.concatenate(both) for both in zip(*found, strict=True)))
        parts.clear()
        waiting = 0

    def flush() -> Iterator[pa.RecordBatch]:
        merge()
        for kind, (key, counts) in kept.items():
            if kind == BIGRAM:
                often = counts.sum(axis=1) >= LEAST
                key, counts = key[often], np.hstack([counts[often], np.zeros_like(counts[often])])
            for at in range(0, len(key), 1 << 16):
                part = slice(at, at + (1 << 16))
                columns = [np.full(len(key[part]), kind, np.int8), key[part].view(np.int64), *counts[part].T]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["kind", "key", "background", "target", "before_background", "before_target"])
        kept.clear()

    for batch in batches:
        rows = zip(*(batch[c] for c in ("bucket", "kind", "n", "block")), strict=True)
        for bucket, kind, n, block in ((b.as_py(), k.as_py(), n.as_py(), block.as_buffer()) for b, k, n, block in rows):
            if bucket != at_bucket:
                yield from flush()
                at_bucket = bucket
            parts.setdefault(kind, []).append(_unpacked(block, n, 4 if kind == WORD else 2))
            waiting += n
            # as many as are merged already, so that a key is merged a few times at most
            if waiting > max(MERGED, sum(len(key) for key, _ in kept.values())):
                merge()
    yield from flush()


def _at_most(counted: DataFrame, most: int) -> int:
    """The least count such that no more than `most` rows have it; counts are told apart to a sixteenth of an octave."""
    octave = F.floor(F.log2("n") * 16).cast("int")
    rows = counted.groupBy(octave.alias("octave")).agg(F.count("*").alias("rows"), F.min("n").alias("n")).collect()
    least, total = 1 << 62, 0
    for r in sorted(rows, key=lambda r: -r["octave"]):
        total += r["rows"]
        if total > most:
            break
        least = r["n"]
    return least


def _value(bits: Column) -> Column:
    return F.round(bits * UNIT).cast("bigint").alias("value")


def train(marked: DataFrame) -> DataFrame:
    """The table of terms of both models: key, n (occurrences in the corpus) and value (loss under the target less loss
    under the background, in millionths of a bit), from (text, target).

    Every word of every row is counted. Bigrams find the counts of their word in the same table: the most frequent words,
    KNOWN_WORDS at most, are broadcast; of any other word few bigrams exist, these are joined by a shuffle.
    """
    spark = marked.sparkSession
    ship(spark)
    seen = Observation()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, min(partitions * BUCKETS_EACH, BUCKETS))
    blocks = marked.mapInArrow(_count(buckets), "bucket int, kind tinyint, n bigint, block binary")
    blocks = blocks.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    merged = blocks.mapInArrow(
        _merge, "kind tinyint, key bigint, background bigint, target bigint, before_background bigint, before_target bigint"
    )
    merged = merged.withColumn("n", F.col("background") + F.col("target"))
    word = (F.col("kind") == WORD) & (F.col("n") > 0)
    sums = {c: F.coalesce(F.sum(F.when(word, F.col(c))), F.lit(0)).alias(c) for c in ("background", "target")}
    stored = settle(merged.observe(seen, F.count_if(word).alias("words"), *sums.values()), "term-counts")
    size = seen.get

    def chance(side: str) -> Column:
        return (F.col(side) + ADDED) / max(size[side] + ADDED * size["words"], 1.0)

    words = stored.where(word).select("key", "n", _value(F.log2(chance("background")) - F.log2(chance("target"))))
    times = F.col("before_background") + F.col("before_target")
    weight = F.log2(F.col("before_target") + PRIOR) - F.log2(F.col("before_background") + PRIOR)
    before = stored.where((F.col("kind") == WORD) & (times > 0)).select((F.col("key") + int(MARK)).alias("key"), times.alias("n"), _value(weight))
    priced = stored.where(word).select(F.col("key").alias("word"), "n", chance("background").alias("in_background"), chance("target").alias("in_target"))
    common = F.col("n") >= _at_most(priced, KNOWN_WORDS)
    known = F.broadcast(priced.where(common).drop("n"))
    grams = stored.where(F.col("kind") == BIGRAM).select("key", "n", "background", "target", F.shiftrightunsigned("key", 32).alias("word"))
    gain = lambda side: F.log2(1 + F.col(side) / (PRIOR * F.col(f"in_{side}")))
    term = ("key", "n", _value(gain("background") - gain("target")))
    frequent = grams.join(known, "word").select(*term)
    others = grams.join(known, "word", "left_anti").join(priced.where(~common).drop("n"), "word").select(*term)
    table = settle(words.unionByName(before).unionByName(frequent).unionByName(others), "terms")
    forget(stored)
    return table


def _slots(key: np.ndarray) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(31) + (key & np.uint64(0xFFFFFFFF))) & np.uint64(SLOTS - 1)


def _listed(table: DataFrame) -> np.ndarray:
    """The map of the bigrams in the table: SLOTS bits, whatever their number."""
    slot = (F.shiftrightunsigned("key", 32) * 31 + F.col("key").bitwiseAND(0xFFFFFFFF)).bitwiseAND(SLOTS - 1)
    bits = table.where(F.shiftrightunsigned("key", 32) >= int(FIRST)).select((slot / 32768).cast("int").alias("part"), (slot % 32768).alias("bit"))
    parts = bits.repartition("part").groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    listed = np.zeros((SLOTS // 32768, 4096), np.uint8)
    for r in parts:
        listed[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return listed.reshape(-1)


def _look_up(shared):
    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, listed = shared.value
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            for at, n in steps(texts, STEP):
                words, before, sizes = terms(texts.slice(at, n))
                owner = np.repeat(np.arange(n), sizes)
                totals, columns = np.zeros(n, np.int64), []
                for kind, key in ((WORD, words), (BEFORE, before + MARK), (BIGRAM, words << np.uint64(32) | before)):
                    known, values = tables
                    distinct, place = np.unique(key, return_inverse=True)
                    spot = np.searchsorted(known[:-1], distinct)
                    hit = known[spot] == distinct
                    hit &= spot < len(known) - 1
                    sums = np.concatenate([[0], np.cumsum(np.where(hit, values[spot], 0)[place])])
                    ends = np.cumsum(sizes)
                    totals += sums[ends] - sums[ends - sizes]
                    asked = ~hit
                    if kind == BIGRAM:
                        slot = _slots(distinct).astype(np.int64)
                        asked &= (listed[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                    missed = asked[place]
                    ends = np.concatenate([[0], np.cumsum(np.bincount(owner[missed], minlength=n))]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(key[missed].view(np.int64))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, n), pa.array(sizes), pa.array(totals), *columns], ["doc_id", "n_words", "value", "words", "before", "bigrams"]
                )

    return look_up


def _known(frequent: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their values, and a last entry that no search may pass."""
    key, value = frequent.column("key").to_numpy().view(np.uint64), frequent.column("value").to_numpy()
    order = np.argsort(key)
    return np.append(key[order], np.uint64(0)), np.append(value[order], 0).astype(np.int32)


def score(docs: DataFrame, target_ids: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words and the mean difference of losses per word in bits (target less background, so lower is closer to
    the target) of every row of docs.

    target_ids: the ids of the target's documents, in a column of the same name. All other rows are the background; if
    there are none, or no target, that model is its smoothing. Null and empty texts have no words and a null score; null
    ids are background; repeated rows count and are scored each; other columns are ignored; an empty table gives no rows.
    Texts are read twice, and shuffled only to meet more than KNOWN_IDS target ids. Terms are combined before the shuffle, so
    that a word or bigram of every row is one entry a task; known terms never enter the join, so that none in it is in more
    than a small part of the rows.
    """
    spark = docs.sparkSession
    ship(spark)
    wanted = settle(target_ids.select(F.col(key).alias("doc_id")).where(F.col("doc_id").isNotNull()).distinct(), "target-ids")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    few = wanted.limit(KNOWN_IDS + 1).count() <= KNOWN_IDS
    wanted = wanted.withColumn("target", F.lit(True))
    marked = rows.join(F.broadcast(wanted) if few else wanted.hint("shuffle_hash"), "doc_id", "left")
    table = train(marked.select("text", F.coalesce("target", F.lit(False)).alias("target")))
    least = _at_most(table, KNOWN_TERMS)
    frequent = table.where(F.col("n") >= least).select("key", "value").toArrow()
    rare = table.where(F.col("n") < least)
    shared = spark.sparkContext.broadcast((_known(frequent), _listed(rare)))
    lists = ("words", "before", "bigrams")
    looked = rows.mapInArrow(_look_up(shared), f"doc_id {kind}, n_words bigint, value bigint, " + ", ".join(f"{c} array<bigint>" for c in lists))
    stored = settle(looked.withColumn("row", F.monotonically_increasing_id()), "partly-scored")
    asked = stored.select("row", F.explode(F.concat(*lists)).alias("key"))
    answers = asked.join(rare.select("key", F.col("value").alias("more")), "key")
    answers = answers.groupBy("row").agg(F.sum("more").alias("more"))
    total = F.col("value") + F.coalesce("more", F.lit(0))
    difference = F.when(F.col("n_words") > 0, total / F.lit(float(UNIT)) / F.col("n_words"))
    return stored.drop(*lists).join(answers, "row", "left").select("doc_id", "n_words", difference.alias("difference"))
