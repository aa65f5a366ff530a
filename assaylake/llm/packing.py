"""Packing of documents into sequences of a fixed length by bin completion with branch and bound.

Only how many pieces there are of each length matters for the packing, and there are at most `capacity` lengths. So the
search runs on that histogram, whatever the number of documents: a step fills a sequence around the largest piece left
and applies the filling as often as the counts allow. The plan it returns has a few thousand entries at most; Spark then
gives every piece its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assaylake.llm.encoding import binaries, encoder, steps
from assaylake.session import settle

Filling = tuple[int, ...]
#: Effort of the search: nodes it may open, pieces in one filling besides the largest, fillings tried at a node. They
#: bound its time, not what is packed; the best-fit solution is there from the start.
NODES, DEEP, WIDE = 4_000, 4, 6


def waste_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: by total length, and, for every k, if pieces over capacity - k share a sequence
    with pieces under k only."""
    lengths = np.arange(len(counts))
    total = int((counts * lengths).sum())
    best = -(-total // capacity)
    number, size = np.cumsum(counts), np.cumsum(counts * lengths)
    for k in range(0, capacity // 2 + 1):
        large = int(number[-1] - number[capacity - k])
        middle = int(number[capacity - k] - number[capacity // 2])
        small = int(size[capacity // 2] - (size[k - 1] if k else 0))
        free = middle * capacity - int(size[capacity - k] - size[capacity // 2])
        best = max(best, large + middle + max(0, -(-(small - free) // capacity)))
    return best


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, Filling]]:
    """Best-fit decreasing on the histogram: (times, filling) for groups of equally filled sequences."""
    open_: dict[int, list[tuple[int, Filling]]] = {}
    room = np.zeros(capacity + 1, bool)
    done: list[tuple[int, Filling]] = []

    def put(times: int, filling: Filling, left: int) -> None:
        if not times:
            return
        if left:
            open_.setdefault(left, []).append((times, filling))
            room[left] = True
        else:
            done.append((times, filling))

    for length in range(capacity, 0, -1):
        n = int(counts[length])
        while n:
            at = int(np.argmax(room[length:])) + length
            if not room[at]:
                per = min(capacity // length, n)
                put(n // per, (length,) * per, capacity - per * length)
                n %= per
                continue
            times, filling = open_[at].pop()
            if not open_[at]:
                room[at] = False
            per = min(at // length, n)
            used = min(times, n // per)
            put(times - used, filling, at)
            put(used, filling + (length,) * per, at - per * length)
            n -= used * per
    return done + [group for groups in open_.values() for group in groups]


def fillings(counts: np.ndarray, capacity: int, largest: int) -> list[Filling]:
    """Undominated ways to fill a sequence around its largest piece, those with the least waste first.

    A filling is dominated if a piece could be added, or if one of its pieces could be exchanged for a longer one that
    is left: the exchange leaves the shorter piece, which fits wherever the longer one does.
    """
    free = capacity - largest
    left = counts.copy()
    left[largest] -= 1
    found: dict[Filling, int] = {}
    there = np.flatnonzero(left[: free + 1])

    def longest(upto: int, used: Filling) -> int:
        at = int(np.searchsorted(there, upto, side="right")) - 1
        while at >= 0 and left[there[at]] <= used.count(int(there[at])):
            at -= 1
        return int(there[at]) if at >= 0 else 0

    def undominated(filling: Filling, waste: int) -> bool:
        if waste and longest(waste, filling):
            return False
        return all((y := longest(x + waste, filling)) <= x or not waste for x in set(filling))

    def extend(filling: Filling, space: int) -> None:
        if len(found) >= 4 * WIDE:
            return
        if not space or len(filling) == DEEP or not longest(space, filling):
            rest = filling
            while space and (x := longest(space, rest)):
                times = min(space // x, int(left[x]) - rest.count(x))
                rest, space = rest + (x,) * times, space - x * times
            rest = tuple(sorted(rest, reverse=True))
            if undominated(rest, space):
                found[rest] = space
            return
        limit = min(space, filling[-1] if filling else space)
        # the piece that fills the space exactly dominates all others; else some of the longest that fit
        tried, x = 0, longest(limit, filling)
        while x and tried < WIDE:
            extend(filling + (x,), space - x)
            if x == space:
                return
            tried, x = tried + 1, longest(x - 1, filling)

    extend((), free)
    if not found:
        extend_greedy: Filling = ()
        while x := longest(free - sum(extend_greedy), extend_greedy):
            extend_greedy += (x,)
        found[extend_greedy] = free - sum(extend_greedy)
    return [(largest, *f) for f in sorted(found, key=lambda f: (found[f], len(f)))[:WIDE]]


def plan(counts: np.ndarray, capacity: int, nodes: int = NODES) -> list[tuple[int, Filling]]:
    """(times, filling) of as few sequences as the search finds; counts[n] is the number of pieces of length n."""
    counts = np.asarray(counts, np.int64)
    incumbent = best_fit(counts, capacity)
    bound, best = waste_bound(counts, capacity), sum(t for t, _ in incumbent)
    total = int((counts * np.arange(len(counts))).sum())
    # each entry of the stack: counts left, steps so far, sequences and waste so far
    stack: list[tuple[np.ndarray, list, int, int]] = [(counts, [], 0, 0)]
    while stack and best > bound and nodes:
        left, taken, used, waste = stack.pop()
        nodes -= 1
        if waste > (best - 1) * capacity - total:
            continue
        there = np.flatnonzero(left)
        if not len(there):
            if used < best:
                incumbent, best = taken, used
            continue
        # the best fit of what is left, after the steps taken, is a solution too
        if len(taken) % 64 == 63:
            rest = best_fit(left, capacity)
            if (n := used + sum(t for t, _ in rest)) < best:
                incumbent, best = taken + rest, n
        branches = []
        for filling in fillings(left, capacity, int(there[-1])):
            lengths, uses = np.unique(filling, return_counts=True)
            times = int((left[lengths] // uses).min())
            after = left.copy()
            after[lengths] -= uses * times
            lost = waste + times * (capacity - sum(filling))
            if lost <= (best - 1) * capacity - total:
                branches.append((after, [*taken, (times, filling)], used + times, lost))
        stack += reversed(branches)
    return incumbent


@dataclass(frozen=True)
class Places:
    """A plan as sorted intervals of ranks: pieces of `length` with ranks from `start` on go, `uses` to a sequence, into
    sequences from `sequence` on, at `offset`."""

    key: np.ndarray
    start: np.ndarray
    uses: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def places(steps_: list[tuple[int, Filling]]) -> Places:
    rows, next_rank, sequence = [], {}, 0
    for times, filling in steps_:
        offset = 0
        for length in sorted(set(filling), reverse=True):
            uses = filling.count(length)
            rank = next_rank.get(length, 0)
            rows.append((length << 44 | rank, rank, uses, sequence, offset))
            next_rank[length] = rank + uses * times
            offset += uses * length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Places(*(np.ascontiguousarray(table[:, k]) for k in range(5)))


def _pieces(path: str, capacity: int, end: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            keys, texts = batch.column("doc_id"), batch.column("text")
            for at, n in steps(texts):
                ids, ends = own.encode(texts.slice(at, n))
                ids = np.insert(ids, ends[1:], end).astype("<u4")
                ends = ends + np.arange(n + 1)
                sizes = np.diff(ends)
                number = -(-sizes // capacity)
                piece = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
                start = piece * capacity
                length = np.minimum(capacity, np.repeat(sizes, number) - start)
                first = np.repeat(ends[:-1], number) + start
                raw = ids.tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * (a + m)]) for a, m in zip(first.tolist(), length.tolist(), strict=True)]
                # number of pieces of the same length before, in this task
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                before = np.arange(len(order)) - np.searchsorted(ranked, ranked)
                slot = np.empty(len(order), np.int64)
                slot[order] = before + seen[ranked]
                seen += np.bincount(length, minlength=capacity + 1)
                out = {
                    "doc_id": keys.slice(at, n).take(pa.array(np.repeat(np.arange(n), number))),
                    "piece": pa.array(piece.astype(np.int32)),
                    "start": pa.array(start),
                    "length": pa.array(length),
                    "ids_crc32": pa.array(np.array(crc, np.int64)),
                    "part": pa.array(np.full(len(piece), part, np.int64)),
                    "slot": pa.array(slot),
                }
                if with_ids:
                    out["ids"] = binaries(ids, np.concatenate([first, [len(ids)]]))
                yield pa.RecordBatch.from_pydict(out)

    return cut


def cut_pieces(
    docs: DataFrame, vocabulary_path: str, capacity: int, end: int = 0, with_ids: bool = False, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, the task it was cut in and its number among the pieces
    of its length there, and its ids if asked for. Stored, so that task and number stay what they are."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part bigint, slot bigint"
    cut = rows.mapInArrow(_pieces(vocabulary_path, capacity, end, with_ids), schema + ", ids binary" * with_ids)
    return settle(cut, "pieces")


def _place(found):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Places = found.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(p.key, length << 44 | rank, side="right") - 1
            turn, nth = np.divmod(rank - p.start[at], p.uses[at])
            out = {n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
            out["sequence_id"] = pa.array(p.sequence[at] + turn)
            out["offset"] = pa.array(p.offset[at] + nth * length)
            yield pa.RecordBatch.from_pydict(out)

    return place


def place_pieces(pieces: DataFrame, capacity: int, nodes: int = NODES) -> DataFrame:
    """Every piece with its sequence_id and its offset there.

    Histogram and plan are bounded by the capacity, whatever the number of pieces; the rank of a piece among those of
    its length is its number within its task plus the counts of the tasks before it.
    """
    spark = pieces.sparkSession
    tallies = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most `capacity` rows
        counts[row["length"]] = row["n"]
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tallies = tallies.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    ranked = pieces.join(tallies.select("part", "length", "earlier"), ["part", "length"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("slot") + F.col("earlier")).alias("rank")
    )
    found = spark.sparkContext.broadcast(places(plan(counts, capacity, nodes)))
    kind = pieces.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(
        _place(found),
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )


def pack(docs: DataFrame, vocabulary_path: str, capacity: int, end: int = 0, nodes: int = NODES) -> DataFrame:
    """Places of all documents' pieces in sequences of `capacity` tokens: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    Only documents longer than a sequence are cut. Null and empty texts are the end token alone. Rows with null or
    repeated ids, and repeated rows, are packed each on their own; other columns are ignored; an empty table gives no
    rows. Pieces of one length may be any share of all rows: nothing is gathered by length.
    """
    return place_pieces(cut_pieces(docs, vocabulary_path, capacity, end), capacity, nodes)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves, one row each: sequence_id and ids (little-endian unsigned 32-bit), from pieces
    cut with their ids and their places. Ids must be unique."""
    both = placed.select("doc_id", "piece", "sequence_id", "offset").join(pieces.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    parts = both.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.aggregate(F.col("parts.ids"), F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"))
