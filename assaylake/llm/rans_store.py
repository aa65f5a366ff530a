"""Token ids in files, entropy-coded: a static asymmetric numeral system over one shared frequency table.

A stored corpus is a folder with two Parquet tables. `table` holds the quantised frequency of every id. `blocks` holds one
row per block of whole documents, in ascending doc_id order by (part, block): the documents' ids and lengths, and the
payload. A payload decodes on its own, given the table:

    magic "ANS1" | lanes u32 | ids u32 | steps between checkpoints u32 | crc32 of the table u32 | words u32
    checkpoints: for each, place in the words u32, state of every lane u64
    words u32 ...
    crc32 of all before u32

Id k belongs to lane k % lanes; a step decodes one id per lane at once, and lanes whose state falls under 2**31 take the
next words in lane order. A reader may start at any checkpoint, and blocks decode in parallel.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assaylake.llm.encoding import binaries, encoder, steps
from assaylake.session import fresh_path

BITS = 20
LOW = np.uint64(1 << 31)
HEADER = struct.Struct("<4sIIIII")
#: Ids after which a block ends (with the document), and steps between checkpoints.
BLOCK_IDS, CHECKPOINT_STEPS = 1 << 18, 128


@dataclass(frozen=True)
class Table:
    """Frequencies that add up to 2**BITS, sums before them, the id of every slot, and the table's crc32."""

    freq: np.ndarray
    before: np.ndarray
    slots: np.ndarray
    crc: int


@lru_cache(maxsize=2)
def table(raw: bytes) -> Table:
    freq = np.frombuffer(raw, "<u4").astype(np.uint64)
    before = np.cumsum(freq) - freq
    return Table(freq, before, np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64)), zlib.crc32(raw))


def quantise(counts: np.ndarray) -> bytes:
    """Counts by id as frequencies that add up to 2**BITS, none of an id that occurs below 1."""
    counts = np.asarray(counts, np.float64)
    there = counts > 0
    if there.sum() > 1 << BITS:
        raise ValueError(f"more than {1 << BITS} different ids")
    total = 1 << BITS
    if not there.any():
        freq = np.zeros(len(counts), np.int64)
        freq[0] = total
        return freq.astype("<u4").tobytes()
    free = total - int(there.sum())
    freq = np.where(there, 1 + np.floor(counts / counts.sum() * free), 0).astype(np.int64)
    freq[int(np.argmax(freq))] += total - int(freq.sum())
    return freq.astype("<u4").tobytes()


def encode_block(ids: np.ndarray, raw_table: bytes, every: int = CHECKPOINT_STEPS) -> bytes:
    """The payload of a block."""
    t = table(raw_table)
    lanes = 1024 if len(ids) >= 1 << 16 else 64
    rows = -(-len(ids) // lanes)
    padded = np.full(rows * lanes, int(np.argmax(t.freq)), np.int64)
    padded[: len(ids)] = ids
    padded = padded.reshape(rows, lanes)
    state = np.full(lanes, LOW, np.uint64)
    words, marks = [], []
    shift, word = np.uint64(63 - BITS), np.uint64(32)
    for s in range(rows - 1, -1, -1):
        freq, before = t.freq[padded[s]], t.before[padded[s]]
        full = state >= freq << shift
        if freq.min() == 0:
            raise ValueError("an id is not in the table")
        words.append(state[full].astype("<u4"))
        state = np.where(full, state >> word, state)
        high, low = np.divmod(state, freq)
        state = (high << np.uint64(BITS)) + low + before
        if s % every == 0:
            marks.append((s, state))
    words.reverse()
    ends = np.cumsum([0, *map(len, words)])
    out = [HEADER.pack(b"ANS1", lanes, len(ids), every, t.crc, int(ends[-1]))]
    for s, at in reversed(marks):
        out += [struct.pack("<I", int(ends[s])), at.astype("<u8").tobytes()]
    out += [w.tobytes() for w in words]
    payload = b"".join(out)
    return payload + struct.pack("<I", zlib.crc32(payload))


def decode_block(payload: bytes, raw_table: bytes, first: int = 0, upto: int | None = None) -> np.ndarray:
    """Ids first..upto of a block, decoded from the last checkpoint before them."""
    t = table(raw_table)
    if zlib.crc32(payload[:-4]) != struct.unpack("<I", payload[-4:])[0]:
        raise ValueError("a block's checksum is wrong")
    magic, lanes, n, every, crc, n_words = HEADER.unpack_from(payload)
    if magic != b"ANS1" or crc != t.crc:
        raise ValueError("a block of another format or table")
    upto = n if upto is None else min(upto, n)
    if first >= upto:
        return np.zeros(0, np.uint32)
    rows = -(-n // lanes)
    mark = first // lanes // every
    size = 4 + 8 * lanes
    at = HEADER.size + mark * size
    place = struct.unpack_from("<I", payload, at)[0]
    state = np.frombuffer(payload, "<u8", lanes, at + 4).astype(np.uint64)
    words = np.frombuffer(payload, "<u4", n_words, HEADER.size + -(-rows // every) * size).astype(np.uint64)
    begin, end = mark * every, -(-upto // lanes)
    out = np.empty((end - begin, lanes), np.uint32)
    bits, low_bits, word = np.uint64(BITS), np.uint64((1 << BITS) - 1), np.uint64(32)
    for s in range(end - begin):
        slot = state & low_bits
        ids = t.slots[slot]
        out[s] = ids
        state = t.freq[ids] * (state >> bits) + slot - t.before[ids]
        low = np.flatnonzero(state < LOW)
        state[low] = state[low] << word | words[place : place + len(low)]
        place += len(low)
    return out.reshape(-1)[first - begin * lanes : upto - begin * lanes]


def _raw_blocks(path: str, end: int, block_ids: int):
    """Ids of sorted documents gathered into blocks of whole documents."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, block = encoder(path), TaskContext.get().partitionId(), 0
        keys: list = []
        lengths: list[int] = []
        held: list[np.ndarray] = []
        n = 0

        def flush():
            nonlocal block, n
            ids = np.concatenate(held)
            row = {"part": [part], "block": [block], "doc_ids": [list(keys)], "lengths": [list(lengths)], "ids": [ids.astype("<u4").tobytes()]}
            block, n = block + 1, 0
            keys.clear()
            lengths.clear()
            held.clear()
            return pa.RecordBatch.from_pydict(row, schema=schema)

        schema = None
        for batch in batches:
            texts = batch.column("text")
            if schema is None:
                kind = pa.list_(batch.schema.field("doc_id").type)
                fields = [("part", pa.int64()), ("block", pa.int64()), ("doc_ids", kind), ("lengths", pa.list_(pa.int64())), ("ids", pa.binary())]
                schema = pa.schema(fields)
            for at, some in steps(texts):
                ids, ends = own.encode(texts.slice(at, some))
                for k, key in enumerate(batch.column("doc_id").slice(at, some).to_pylist()):
                    held += [ids[ends[k] : ends[k + 1]], np.array([end], np.uint32)]
                    size = int(ends[k + 1] - ends[k]) + 1
                    keys.append(key)
                    lengths.append(size)
                    n += size
                    if n >= block_ids:
                        yield flush()
        if keys:
            yield flush()

    return gather


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        for raw in batch.column("ids"):
            more = np.bincount(np.frombuffer(raw.as_buffer(), "<u4"), minlength=len(counts))
            more[: len(counts)] += counts
            counts = more
    ids = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"id": pa.array(ids), "n": pa.array(counts[ids])})


def _encode(shared):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, raw in enumerate(batch.column("ids")):
                payload = encode_block(np.frombuffer(raw.as_buffer(), "<u4"), shared.value)
                out = {n: batch.column(n).slice(k, 1) for n in ("part", "block", "doc_ids", "lengths")}
                yield pa.RecordBatch.from_pydict(out | {"payload": pa.array([payload], pa.binary())})

    return encode


def write_corpus(
    docs: DataFrame, folder: str, vocabulary_path: str, end: int = 1, block_ids: int = BLOCK_IDS, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode all documents, each with the end id, and store them in `folder` in ascending order of their ids.

    Null and empty texts are the end id alone; null ids come first, rows with the same id stand together in any order;
    other columns are ignored; an empty table stores no blocks. The texts are shuffled once, by ranges of ids. Plain ids
    are stored beside the folder first, since the shared table needs the counts of all; at most one count per id of the
    vocabulary reaches the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id")
    blocks = f"part bigint, block bigint, doc_ids array<{kind}>, lengths array<bigint>, "
    plain = fresh_path(spark, "plain-ids")
    gathered = ordered.mapInArrow(_raw_blocks(vocabulary_path, end, block_ids), blocks + "ids binary")
    gathered.write.option("compression", "zstd").parquet(plain)
    stored = spark.read.schema(blocks + "ids binary").parquet(plain)
    found = stored.select("ids").mapInArrow(_count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in found), default=0) + 1, np.int64)
    for r in found:
        counts[r["id"]] = r["n"]
    raw = quantise(counts)
    freq = np.frombuffer(raw, "<u4")
    spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq)], "id bigint, freq bigint").coalesce(1).write.mode("overwrite").parquet(f"{folder}/table")
    shared = spark.sparkContext.broadcast(raw)
    coded = stored.mapInArrow(_encode(shared), blocks + "payload binary")
    coded.write.mode("overwrite").option("compression", "none").parquet(f"{folder}/blocks")


def open_table(spark: SparkSession, folder: str) -> bytes:
    """The shared table, one frequency per id of the vocabulary."""
    return np.array([r["freq"] for r in spark.read.parquet(f"{folder}/table").orderBy("id").collect()], "<u4").tobytes()


def _decode(shared):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, payload in enumerate(batch.column("payload").to_pylist()):
                ids = decode_block(payload, shared.value)
                keys, lengths = batch.column("doc_ids")[k].values, batch.column("lengths")[k].values
                ends = np.concatenate([[0], np.cumsum(lengths.to_numpy())]).astype(np.int64)
                n = len(keys)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": keys,
                        "part": pa.array(np.full(n, batch.column("part")[k].as_py())),
                        "block": pa.array(np.full(n, batch.column("block")[k].as_py())),
                        "offset": pa.array(ends[:-1]),
                        "ids": binaries(ids, ends),
                    }
                )

    return decode


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The stored documents, decoded from the files: doc_id, part, block, offset (ids of the block before it), n_tokens
    and ids (little-endian unsigned 32-bit)."""
    stored = spark.read.parquet(f"{folder}/blocks")
    kind = stored.schema["doc_ids"].dataType.elementType.simpleString()
    shared = spark.sparkContext.broadcast(open_table(spark, folder))
    schema = f"doc_id {kind}, part bigint, block bigint, offset bigint, ids binary"
    return stored.mapInArrow(_decode(shared), schema).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("bigint"))


def with_starts(read: DataFrame, folder: str) -> DataFrame:
    """Adds start, the ids of all documents before, to what has part, block and offset, and drops these. Only block sizes
    are summed, never documents. Drop ids that aren't needed first: the join moves the rows."""
    stored = read.sparkSession.read.parquet(f"{folder}/blocks")
    sizes = stored.select("part", "block", F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part: as many as partitions
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    base = sizes.join(parts, "part").select("part", "block", (F.col("inside") + F.col("earlier")).alias("base"))
    return read.join(base, ["part", "block"]).withColumn("start", F.col("base") + F.col("offset")).drop("part", "block", "offset", "base")
