"""Near duplicates by the Jaccard similarity of word shingles, found by prefix filters under several global orders.

Under any total order of the shingles, two sets that are similar enough share shingles among the first of both, and how
many they must share follows from their sizes. The filters of three orders are intersected: postings under the first give
candidates, the other two are checked on the candidates, and what passes all is verified on the whole sets.

The first order puts shingles that many documents share last, so that common passages join no one. Large groups of near
copies are not paired off: within a posting list, documents in a hashed sequence are compared with their neighbours
first, which connects such groups; only documents that are then still in different components are compared in full.
Bits of the sets, which differ in at most as many places as the sets do, keep pairs that cannot be similar from leaving
a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assaylake.llm.encoding import binaries, steps
from assaylake.llm.hashing import shingles, spread
from assaylake.llm.rows import unwrap, wrap
from assaylake.session import settle

#: Similarity in hundredths, and words of a shingle.
PERCENT, WIDTH = 80, 5
#: Hashes are kept in this many bits where they only order or compare shingles.
BITS = 48
#: Shingles of this part of the hash space come first in the first order, and only they are counted: prefixes are a fifth.
REGION = int(0.25 * (1 << BITS))
#: A shingle is common if it is in at least so many documents; so many of the commonest are known to all tasks. Both only
#: decide the order, which may be any: they change the work, never the result.
COMMON, COMMON_KEPT = 64, 1_000_000
#: Bits of the map of shingles that occur twice or more: 8 MB whatever the input. A fuller map lets more single ones by.
MAP_BITS = 1 << 26
#: Documents that a posting list holds before it is split for comparing neighbours, or compared in blocks.
LIST = 1024
#: A set's tokens as bits, in words of 64. Each bit in which two sets differ stands for a shingle that only one of them has.
MASK = 16
MASKS = [f"mask{k}" for k in range(MASK)]
STEP_BYTES = 1 << 20


def _least_overlap(n, m):
    """Shingles that sets of sizes n and m share at least if they are similar enough."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def prefix_size(n):
    return n - -(-PERCENT * n // 100) + 1


def _needed(n, m):
    """Shingles that the prefixes of similar sets share at least, under any order."""
    o = _least_overlap(n, m)
    return np.maximum(1, np.minimum(prefix_size(n) - (n - o), prefix_size(m) - (m - o)))


def _short(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - BITS)


def _pack(tokens: np.ndarray) -> np.ndarray:
    """48-bit numbers as rows of six bytes."""
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _packed(tokens: np.ndarray, ends: np.ndarray) -> pa.Array:
    return binaries(_pack(tokens).reshape(-1), ends * 6)


def _unpack(raw: bytes | pa.Buffer) -> np.ndarray:
    packed = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    out = np.zeros((len(packed), 8), np.uint8)
    out[:, :6] = packed
    return out.view("<u8").reshape(-1).astype(np.uint64)


def _place(tokens: np.ndarray) -> np.ndarray:
    """Bit of the map that stands for a token."""
    return (spread(tokens, salt=7) % np.uint64(MAP_BITS)).astype(np.int64)


def _region_tokens(buckets: int):
    """Per task and bucket, the tokens of the counted region, once for every document they are in."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            for at, n in steps(texts, STEP_BYTES):
                hashes, _ = shingles(texts.slice(at, n), WIDTH)
                tokens = _short(hashes)
                tokens = tokens[tokens < REGION]
                bucket = _bucket(_place(tokens), buckets)
                order = np.argsort(bucket, kind="stable")
                ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
                yield pa.RecordBatch.from_pydict({"bucket": pa.array(np.arange(buckets)), "tokens": _packed(tokens[order], ends)})

    return emit


def _tally(buckets: int):
    """From all tokens of a bucket: the common ones with their counts, and the bucket's part of the map."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for bucket, raw in zip(batch.column("bucket").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                held.setdefault(bucket, []).append(_unpack(raw))
        for bucket, parts in held.items():
            tokens, n = np.unique(np.concatenate(parts), return_counts=True)
            low, high = _range(bucket, buckets)
            bits = np.zeros(high - low, bool)
            bits[_place(tokens[n > 1]) - low] = True
            common = n >= COMMON
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([bucket]),
                    "common": pa.array([tokens[common].astype(np.int64)], pa.list_(pa.int64())),
                    "n": pa.array([n[common].astype(np.int64)], pa.list_(pa.int64())),
                    "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
                }
            )

    return tally


class Order:
    """What all tasks know of the shingles: the common ones, sorted, with their ranks, and the map of repeated ones."""

    def __init__(self, common: np.ndarray, rank: np.ndarray, repeated: np.ndarray):
        self.common, self.rank, self.repeated = common, rank, repeated

    def may_repeat(self, tokens: np.ndarray) -> np.ndarray:
        """False only for tokens that no second document has. Beyond the counted region nothing is known."""
        at = _place(tokens)
        return ((self.repeated[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool) | (tokens >= REGION)

    def keys(self, tokens: np.ndarray, order: int) -> np.ndarray:
        """Sort keys under an order: 0 takes the counted region first and common shingles last; the others take common
        ones last too, and all else by another hash."""
        if order == 0:
            key = np.where(tokens < REGION, tokens, tokens + np.uint64(1 << BITS))
        else:
            key = spread(tokens, salt=order) >> np.uint64(64 - BITS)
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, tokens), len(self.common) - 1)
            key = np.where(self.common[at] == tokens, np.uint64(3 << BITS) + self.rank[at], key)
        return key


def learn_order(texts: DataFrame) -> Order:
    """Count the region's shingles over all documents. What reaches the driver is bounded: COMMON_KEPT tokens at most,
    cut by the commonest counts, and the map."""
    spark = texts.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = texts.mapInArrow(_region_tokens(buckets), "bucket bigint, tokens binary").repartition(buckets, "bucket")
    tallied = settle(dealt.mapInArrow(_tally(buckets), "bucket bigint, common array<bigint>, n array<bigint>, bits binary"), "shingle-tallies")
    listed = tallied.select(F.explode(F.arrays_zip("common", "n")).alias("c")).select("c.common", "c.n")
    table = listed.orderBy(F.desc("n"), "common").limit(COMMON_KEPT).select("common").toArrow()
    tokens = table["common"].to_numpy().astype(np.uint64)
    by_token = np.argsort(tokens)
    rank = np.arange(len(tokens), dtype=np.uint64)[::-1]  # the commonest comes last
    return Order(tokens[by_token], rank[by_token], _whole_map(tallied, buckets))


def _masks(tokens: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Every text's tokens as MASK words of bits; a row per word."""
    bit = (spread(tokens, salt=8) % np.uint64(64 * MASK)).astype(np.int64)
    out = np.zeros((n, MASK * 64), bool)
    out[owner, bit] = True
    packed = np.packbits(out.reshape(n, MASK, 64), axis=2, bitorder="little")
    return np.ascontiguousarray(packed.reshape(n, MASK, 8)).view("<i8").reshape(n, MASK).T


def _describe(shared):
    """Per document: size and digest of its set, its bits, the first order's prefix without tokens that are in no other document,
    and 16 bits of every token of the other two prefixes."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order: Order = shared.value
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            for at, n in steps(texts, STEP_BYTES):
                hashes, sizes = shingles(texts.slice(at, n), WIDTH)
                tokens, ends = _short(hashes), np.concatenate([[0], np.cumsum(sizes)])
                owner = np.repeat(np.arange(n), sizes)
                first = np.where(sizes > 0, prefix_size(sizes), 0)
                place = np.arange(len(tokens)) - ends[owner]
                within = place < first[owner]
                columns = []
                for k in range(3):
                    sorted_ = np.lexsort((order.keys(tokens, k), owner))[within]
                    chosen, whose = tokens[sorted_], owner[within]
                    if k == 0:
                        useful = order.may_repeat(chosen)
                        chosen, whose = chosen[useful], whose[useful]
                        cut = np.searchsorted(whose, np.arange(n + 1))
                        lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(chosen.astype(np.int64)))
                        columns.append(lists)
                    else:
                        short = (spread(chosen, salt=10 + k) >> np.uint64(48)).astype("<u2")
                        columns.append(binaries(short, np.searchsorted(whose, np.arange(n + 1))))
                raw = hashes.tobytes()
                digests = [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, n), pa.array(sizes), pa.array(digests, pa.binary()), *columns, *map(pa.array, _masks(tokens, owner, n))],
                    ["doc_id", "n", "digest", "first", "second", "third", *MASKS],
                )

    return describe


def _sets(shared):
    """Whole sets of the documents whose place is in the map."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            place = batch.column("place").to_numpy()
            wanted = pa.array(((bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1).astype(bool))
            ids, texts = batch.column("doc_id").filter(wanted), pc.fill_null(batch.column("text").filter(wanted), "")
            for at, n in steps(texts, STEP_BYTES):
                hashes, sizes = shingles(texts.slice(at, n), WIDTH)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, n), _packed(_short(hashes), np.concatenate([[0], np.cumsum(sizes)]))], ["doc_id", "tokens"]
                )

    return sets


def _slices(buckets: int):
    """Places of a map as its slices."""

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            place = batch.column("place").to_numpy()
            bucket = _bucket(place, buckets)
            for k in np.unique(bucket).tolist():
                low, high = _range(k, buckets)
                held.setdefault(k, np.zeros(high - low, bool))[place[bucket == k] - low] = True
        for k, bits in held.items():
            yield pa.RecordBatch.from_pydict({"bucket": pa.array([k]), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    return slices


def _bucket(place: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each place; the places of a byte of the map have the same."""
    return place // 8 * buckets // (MAP_BITS // 8)


def _range(bucket: int, buckets: int) -> tuple[int, int]:
    """Places of the map that belong to a bucket, in whole bytes."""
    return 8 * -(-bucket * (MAP_BITS // 8) // buckets), 8 * -(-(bucket + 1) * (MAP_BITS // 8) // buckets)


def _whole_map(slices: DataFrame, buckets: int) -> np.ndarray:
    """The map from its slices (bucket, bits): a fixed size on the driver, one bit a place at all times."""
    out = np.zeros(MAP_BITS // 8, np.uint8)
    for r in slices.select("bucket", "bits").toLocalIterator():
        low, high = _range(r["bucket"], buckets)
        out[low // 8 : high // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _pass_orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose prefixes under the second and third order share enough. 16-bit tokens can only share more."""
    for batch in batches:
        cols = {c: batch.column(c) for c in ("a", "b")}
        need = _needed(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy())
        keep = np.ones(batch.num_rows, bool)
        for name in ("second", "third"):
            left, right = batch.column(f"{name}_a"), batch.column(f"{name}_b")
            for k in np.flatnonzero(keep):
                x = np.frombuffer(left[k].as_buffer(), "<u2")
                y = np.frombuffer(right[k].as_buffer(), "<u2")
                # a token of either counts as often as the other has it, at most as often as it stands there itself
                keep[k] = min(int(np.isin(x, y).sum()), int(np.isin(y, x).sum())) >= need[k]
        yield pa.RecordBatch.from_pydict({c: v.filter(pa.array(keep)) for c, v in cols.items()})


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        left, right = batch.column("tokens_a"), batch.column("tokens_b")
        for k in range(batch.num_rows):
            x, y = _unpack(left[k].as_buffer()), _unpack(right[k].as_buffer())
            n, m = len(x), len(y)
            shared = _common(x, y)
            keep[k] = 100 * shared >= PERCENT * (n + m - shared)
        yield pa.RecordBatch.from_pydict({c: batch.column(c).filter(pa.array(keep)) for c in ("a", "b")})


def _fits(n: Column, m: Column) -> Column:
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _close(n: Column, m: Column, left: list[Column], right: list[Column]) -> Column:
    """Similar sets differ in few shingles, hence in few bits. True for all pairs that are similar enough."""
    least = F.ceil(PERCENT * (n + m) / (100 + PERCENT))
    differ = reduce(add, (F.bit_count(a.bitwiseXOR(b)) for a, b in zip(left, right, strict=True)))
    return differ <= n + m - 2 * least


class _Checker:
    """Candidate pairs (a, b) of classes to links: the other orders' filters, then the whole sets.

    Only the candidates' texts are cut into shingles again; tasks tell them by a map of their ids' hashes, and the few
    others that fall on the same places are dropped by the join.
    """

    def __init__(self, docs: DataFrame, described: DataFrame):
        self.docs = docs.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(MAP_BITS)))
        self.described = described.select("doc_id", "n", "second", "third", *MASKS)
        self.kind = described.schema["doc_id"].dataType.simpleString()

    def __call__(self, pairs: DataFrame, label: str) -> DataFrame:
        spark = self.docs.sparkSession
        both = f"a {self.kind}, b {self.kind}"
        for side in ("a", "b"):
            d = self.described.select(*(F.col(c).alias(side if c == "doc_id" else f"{c}_{side}") for c in self.described.columns))
            pairs = pairs.join(d, side)
        sides = [[F.col(f"{m}_{side}") for m in MASKS] for side in ("a", "b")]
        pairs = pairs.where(_close(F.col("n_a"), F.col("n_b"), *sides)).drop(*(f"{m}_{side}" for m in MASKS for side in ("a", "b")))
        passed = settle(pairs.mapInArrow(_pass_orders, both), f"{label}-passed")
        if passed.isEmpty():
            return passed
        buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        ids = passed.select(F.col("a").alias("id")).union(passed.select(F.col("b").alias("id")))
        places = ids.select(F.pmod(F.xxhash64("id"), F.lit(MAP_BITS)).alias("place")).distinct()
        places = places.repartition(buckets, F.floor(F.floor(F.col("place") / 8) * buckets / (MAP_BITS // 8)))
        wanted = spark.sparkContext.broadcast(_whole_map(places.mapInArrow(_slices(buckets), "bucket bigint, bits binary"), buckets))
        sets = self.docs.mapInArrow(_sets(wanted), f"doc_id {self.kind}, tokens binary")
        sets = settle(sets, f"{label}-sets").distinct()
        for side in ("a", "b"):
            passed = passed.join(sets.select(F.col("doc_id").alias(side), F.col("tokens").alias(f"tokens_{side}")), side)
        return settle(passed.mapInArrow(_verify, both), f"{label}-links")


def _roots(up: DataFrame) -> DataFrame:
    """`up` (id, up) with `up` replaced by where the chain of ups ends, in as many rounds as the longest chain has doublings.
    Many ids may have one up; adaptive execution splits such joins."""
    while True:
        above = up.select(F.col("id").alias("up"), F.col("up").alias("next"))
        moved = settle(up.join(above, "up").select("id", "up", "next"), "roots")
        up = moved.select("id", F.col("next").alias("up"))
        if moved.where("up != next").isEmpty():
            return up


def components(edges: DataFrame) -> DataFrame:
    """id and the smallest id reachable from it (component), of every id in edges (a, b).

    In every round each id moves to its smallest neighbour, if that is smaller, and on to where that one goes; edges are then
    drawn between where their ends went, and those within one place are dropped. So the edges get fewer from round to round,
    and every stored table cuts the lineage. The smallest id of a component never moves, so it is what remains.
    """
    kind = edges.schema["a"].dataType.simpleString()
    rounds = []
    while True:
        edges = settle(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = _roots(settle(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("up")), "ups"))
        rounds.append(up)
        ends = [up.select(F.col("id").alias(c), F.col("up").alias(f"{c}_up")) for c in ("a", "b")]
        edges = edges.join(ends[0], "a").join(ends[1], "b").select(F.col("a_up").alias("a"), F.col("b_up").alias("b"))
    if not rounds:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    labels = rounds[0]
    for up in rounds[1:]:
        later = up.select(F.col("id").alias("up"), F.col("up").alias("next"))
        labels = labels.join(later, "up", "left").select("id", F.coalesce("next", "up").cast(kind).alias("up"))
    return settle(labels.select("id", F.col("up").alias("component")), "components")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of every row: doc_id, n_shingles (size of its set) and component_id (smallest id reachable by links, its own
    included).

    Documents link if 100 * common >= 80 * united shingles; equal sets are one class and link through its smallest id.
    Null and empty texts and those without words have size 0 and link with nothing. A row with a null id links with
    nothing and has a null component. Rows with the same id are one document with several texts. Other columns are
    ignored; an empty table gives no rows.

    Nothing is capped: a full list of common shingles or a full map only leave more for the exact filters to do. Lists
    are compared in blocks of LIST. Texts are never shuffled; they are read again for the candidates.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(learn_order(rows.select("text")))
    schema = f"doc_id {kind}, n bigint, digest binary, first array<bigint>, second binary, third binary, "
    schema += ", ".join(f"{m} bigint" for m in MASKS)
    described = settle(rows.mapInArrow(_describe(shared), schema), "described")
    linked = described.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = settle(linked.groupBy("digest").agg(F.min("doc_id").alias("class_id")), "classes")

    # postings of the classes' first members
    posted = linked.where(F.size("first") > 0).join(classes, "digest").where(F.col("doc_id") == F.col("class_id"))
    posted = posted.dropDuplicates(["doc_id", "digest"]).select(F.explode("first").alias("token"), F.col("doc_id").alias("id"), "n")
    counts = posted.groupBy("token").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    postings = settle(posted.join(counts, "token"), "postings")

    check = _Checker(rows.where(F.col("doc_id").isNotNull()), linked.dropDuplicates(["doc_id", "digest"]))
    split = F.ceil(F.col("members") / LIST)
    sublist = postings.withColumn("sub", F.pmod(F.xxhash64("id"), split))
    near = Window.partitionBy("token", "sub").orderBy(F.xxhash64("id", "token"), "id")
    beside = sublist.withColumn("other", F.lag("id").over(near)).withColumn("m", F.lag("n").over(near))
    beside = beside.where(F.col("other").isNotNull() & _fits(F.col("n"), F.col("m")))
    ordered = [F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")]
    links = check(beside.select(*ordered).where("a != b").distinct(), "neighbours")

    # documents still in different components, compared with all others of their lists
    found = components(links)
    placed = postings.join(found, "id", "left").withColumn("component", F.coalesce("component", F.col("id")))
    placed = settle(placed, "placed")
    tallies = placed.groupBy("token", "component").agg(F.count(F.lit(1)).alias("size"))
    main = tallies.groupBy("token").agg(F.max(F.struct("size", "component")).alias("main"), F.count(F.lit(1)).alias("kinds"))
    main = main.where("kinds > 1").select("token", F.col("main.component").alias("main"))
    mixed = placed.join(main, "token").withColumn("blocks", F.ceil(F.col("members") / LIST).cast("int"))
    bits = linked.select(F.col("doc_id").alias("id"), "n", *MASKS).distinct()
    mixed = mixed.join(bits, ["id", "n"])
    home = mixed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    minor = mixed.where(F.col("component") != F.col("main")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    a, b = minor.alias("x"), home.alias("y")
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))
    met = a.join(
        b,
        (F.col("x.token") == F.col("y.token")) & (F.col("x.block") == F.col("y.block"))
        & (F.col("x.component") != F.col("y.component")) & once & _fits(F.col("x.n"), F.col("y.n"))
        & _close(F.col("x.n"), F.col("y.n"), *([F.col(f"{side}.{m}") for m in MASKS] for side in ("x", "y"))),
    )
    met = met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"), F.col("x.n").alias("n"), F.col("y.n").alias("m"))
    # such pairs meet once in every list they share, so the meetings are the first order's shared prefix
    shares = met.groupBy("a", "b", "n", "m").agg(F.count(F.lit(1)).alias("times"))
    least = F.ceil(PERCENT * (F.col("n") + F.col("m")) / (100 + PERCENT))
    prefix = lambda c: c - F.ceil(PERCENT * c / 100) + 1 - (c - least)
    enough = F.col("times") >= F.least(prefix(F.col("n")), prefix(F.col("m")))
    rest = check(shares.where(enough).select("a", "b").where("a != b").distinct(), "rest")

    # one id with several texts joins their classes
    member = settle(linked.select("doc_id", "n", "digest").join(classes, "digest").select("doc_id", "class_id"), "members")
    same = member.groupBy("doc_id").agg(F.min("class_id").alias("b"), F.max("class_id").alias("a")).where("a != b")
    several = member.join(same.select("doc_id", "b"), "doc_id").where("class_id != b").select(F.col("class_id").alias("a"), "b")
    # the neighbours' components are places already; further links join places
    def place(pairs: DataFrame) -> DataFrame:
        for c in ("a", "b"):
            pairs = pairs.join(found.select(F.col("id").alias(c), F.col("component").alias(f"{c}_in")), c, "left")
        return pairs.select(*(F.coalesce(f"{c}_in", F.col(c)).alias(c) for c in ("a", "b")))

    joined = components(place(rest.union(several)))
    onward = joined.select(F.col("id").alias("component"), F.col("component").alias("further"))
    moved = found.join(onward, "component", "left").select("id", F.coalesce("further", "component").alias("component"))
    final = moved.unionByName(joined.join(found.select("id"), "id", "left_anti"))
    ids = member.groupBy("doc_id").agg(F.min("class_id").alias("class_id")).join(final.withColumnRenamed("id", "class_id"), "class_id", "left")
    ids = ids.select(F.col("doc_id").alias("own"), F.coalesce("component", "class_id").alias("component_id"))
    out = described.select("doc_id", F.col("n").alias("n_shingles")).join(ids, F.col("doc_id") == F.col("own"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _listed(ids: DataFrame) -> DataFrame:
    """The map of the places of ids (doc_id), as rows of 32,768 places: 8 MB at most, whatever their number."""
    place = ids.select(F.pmod(F.xxhash64("doc_id"), F.lit(MAP_BITS)).alias("place"))
    bits = place.select(F.floor(F.col("place") / 32768).alias("part"), (F.col("place") % 32768).alias("bit"))
    return bits.repartition("part").groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _told_apart(wrapped: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that have none of the ids, as the map of their places shows, and the others: those that have one, and as many
    more as the map is full."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(MAP_BITS))
    mapped = wrapped.withColumn("part", F.floor(place / 32768)).join(F.broadcast(_listed(ids)), "part", "left")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(place % 32768 / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.pow(F.lit(2), place % 8).cast("int")
    mapped = mapped.withColumn("listed", F.coalesce(byte.bitwiseAND(bit) != 0, F.lit(False)))
    free, asked = (mapped.where(F.col("listed") == there).select(*wrapped.columns) for there in (False, True))
    return free, asked


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, in all their columns, without near duplicates: of every component the document with the smallest
    id, and of its rows one. Rows with a null id stay. Texts are shuffled only if their id is, or falls on the place of, one
    that goes, and all that are left if ids repeat."""
    wrapped = wrap(docs, key, text)
    found = settle(join(docs, key, text), "components-of-all")
    gone = found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    gone = settle(gone, "gone")
    free, asked = _told_apart(wrapped, gone)
    left = free.unionByName(asked.join(gone.hint("shuffle_hash"), "doc_id", "left_anti"))
    again = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and doc_id is not null")
    if again.isEmpty():
        return unwrap(left)
    return unwrap(left.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(left.where("doc_id is null")))
