"""Trie of conversations that begin alike, by adaptive radix trees over turn ids.

A turn's id is 16 bytes, big-endian: the leading half of the SHA-256 of its role and text. A conversation's key is the ids
of its turns one after the other. Equal conversations are one key. Keys are cut into ranges; every task builds the tree of
its range, and walks it: of all byte depths, only those that are a whole number of turns are nodes. A node whose members
lie in several ranges is a beginning of a range's first or last key; all its figures add up, so such nodes are merged by
one small aggregate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.llm.radix_tree import Tree
from assaylake.session import settle

#: Bytes of a turn id, and keys of a range: the tree of a range takes about 1 KB a key.
WIDTH, RANGE = 16, 40_000
#: Turns that leaders lend to the conversations after them, and conversations of one leader.
LENT, FOLLOWERS = 4, 20
#: Ids of conversations that end at the same node are joined in blocks of so many numbers.
BLOCK = 1 << 14
#: Merged nodes whose ids are broadcast to name the parents; beyond that they are joined, each repeated for SALTS.
BROADCAST_ROWS, SALTS = 200_000, 64
ROWS = 20_000
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """32 hexadecimal digits; role and text cannot run into each other."""
    head = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(head, 256), 1, 2 * WIDTH)


def timelines(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, as an array of (id, words). Turns with the same number come in the order of their ids.
    24 bytes a turn: a conversation is handled whole, like a text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")
    turns = conversations.where("conv_id is not null").select("conv_id", F.struct("turn", turn_id(role, text).alias("id"), words.alias("words")).alias("t"))
    ordered = F.sort_array(F.collect_list("t"))
    return turns.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def rebuild(lines: DataFrame) -> DataFrame:
    """Every conversation c after its leader's first h turns (the leader is c - c % FOLLOWERS, h is crc32(c) % LENT), its own
    first h left out."""
    heads = lines.where(F.col("conv_id") % FOLLOWERS == 0).select(F.col("conv_id").alias("leader"), F.slice("turns", 1, LENT - 1).alias("head"))
    lines = lines.withColumn("leader", F.col("conv_id") - F.col("conv_id") % FOLLOWERS)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT).cast("int")
    lent = F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), h)
    own = F.slice("turns", h + 1, F.size("turns"))
    return lines.join(heads, "leader", "left").select("conv_id", F.concat(lent, own).alias("turns"))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From blocks in the order of key and block: every key once, with the digest of its members' ids."""
    held, out = None, []
    for batch in batches:
        for key, words, chunk, n, least in zip(*(batch.column(c).to_pylist() for c in ("key", "words", "chunk", "n", "least")), strict=True):
            if held is not None and held[0] == key:
                held[2] += n
                held[3] = min(held[3], least)
                held[4].update(b",")
            else:
                if held is not None:
                    out.append(held)
                held = [key, words, n, least, hashlib.sha256()]
            held[4].update(chunk.encode())
        if len(out) >= ROWS:
            yield _keys(out)
            out = []
    if held is not None:
        yield _keys([*out, held])


def _keys(rows: list[list]) -> pa.RecordBatch:
    key, words, n, least, digest = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.binary()), pa.array(words, pa.list_(pa.int64())), pa.array(n, pa.int64()), pa.array(least, pa.int64()), pa.array([d.hexdigest() for d in digest])],
        ["key", "words", "n", "least", "ends"],
    )


def keys(rebuilt: DataFrame) -> DataFrame:
    """Every distinct conversation: key, words of its turns, number and least id of its members, digest of all their ids.

    A frequent conversation is dealt out by blocks of its members' ids; what then comes together in one task is a row per
    block, and streams through it."""
    rows = rebuilt.select(
        F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("key"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
        F.floor(F.col("conv_id") / BLOCK).alias("block"),
        F.col("conv_id").cast("bigint").alias("conv_id"),
    )
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = rows.groupBy("key", "block").agg(
        listed.alias("chunk"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.any_value("words").alias("words")
    )
    dealt = blocks.repartition("key").sortWithinPartitions("key", "block")
    return dealt.mapInArrow(_ends, "key binary, words array<bigint>, n bigint, least bigint, ends string")


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns that a range's first key shares with the key before it, and its last key with the one after it (-1: there is
    none), and whether that one goes on where the last key ends."""

    def shared(a: bytes | None, b: bytes | None) -> int:
        if a is None or b is None:
            return -1
        turns = min(len(a), len(b)) // WIDTH
        return next((k for k in range(turns) if a[k * WIDTH : (k + 1) * WIDTH] != b[k * WIDTH : (k + 1) * WIDTH]), turns)

    for batch in batches:
        rows = batch.to_pylist()
        after = [r["after"] is not None and r["after"].startswith(r["high"]) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("part"),
                pa.array([shared(r["before"], r["low"]) for r in rows], pa.int64()),
                pa.array([shared(r["high"], r["after"]) for r in rows], pa.int64()),
                pa.array(after, pa.bool_()),
            ],
            ["part", "left", "right", "goes_on"],
        )


OUT = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends string, node binary, parent binary"
_SCHEMA = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends", pa.string()), ("node", pa.binary()), ("parent", pa.binary())]
)


class _Node:
    __slots__ = ("depth", "words", "n", "least", "ends", "left", "kids", "own_kids", "leaves", "saved", "rows")

    def __init__(self, depth: int, left: bool):
        self.depth, self.left = depth, left
        self.words, self.n, self.least, self.ends = -1, 0, None, None
        self.kids = self.own_kids = self.leaves = self.saved = 0
        self.rows: list[list] = []


def _walk(tree: Tree, rows: list[tuple], left: int, right: int, goes_on: bool) -> Iterator[list]:
    """The nodes of a range's tree. Nodes that other ranges share (`node` names them by digest) come with this range's part of
    their figures; their children name them as `parent`."""
    seen, key = 0, b""
    open_ = [_Node(0, True)]

    def name(depth: int) -> bytes:
        return hashlib.blake2b(key[: depth * WIDTH], digest_size=16).digest()

    def close() -> Iterator[list]:
        node = open_.pop()
        last = seen == len(rows)  # the range's last key is among its members
        other = node.left and node.depth <= left  # an earlier range has it too, and counts it
        shared = other or (last and node.depth <= right)
        node.saved += (node.n - (0 if other else 1)) * max(node.words, 0)
        if not node.kids and not (last and goes_on):
            node.leaves += 1
        for row in node.rows:
            row[2], row[9] = (None, name(node.depth)) if shared else (node.least, None)
            yield row
        row = [node.least, node.depth, None, node.n, node.own_kids, node.leaves, node.saved, node.ends, name(node.depth) if shared else None, None]
        if open_:
            above = open_[-1]
            above.n += node.n
            above.least = node.least if above.least is None else min(above.least, node.least)
            above.kids += 1
            above.own_kids += not other
            above.leaves += node.leaves
            above.saved += node.saved
            above.rows.append(row)
        else:
            yield row

    for end, value in tree.walk():
        if value == -2:
            while len(open_) - 1 > end // WIDTH:
                yield from close()
            continue
        for depth in range(len(open_), end // WIDTH + 1):
            open_.append(_Node(depth, seen == 0))
        if value >= 0:
            key, words, n, least, ends = rows[value]
            for node in reversed(open_[1:]):
                if node.words >= 0:
                    break
                node.words = words[node.depth - 1]
            node = open_[-1]
            node.n += n
            node.least = least if node.least is None else min(node.least, least)
            node.ends = ends
            seen += 1
    while open_:
        yield from close()


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one range."""
    rows, border = [], None
    for batch in batches:
        rows += zip(*(batch.column(c).to_pylist() for c in ("key", "words", "n", "least", "ends")), strict=True)
        border = border or tuple(batch.column(c)[0].as_py() for c in ("left", "right", "goes_on")) if batch.num_rows else border
    if not rows:
        return
    tree = Tree()
    for at, row in enumerate(rows):
        tree.insert(row[0], at)
    out: list[list] = []
    for row in _walk(tree, rows, *border):
        out.append(row)
        if len(out) >= ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def trie(members: DataFrame, width: int = RANGE) -> DataFrame:
    """The nodes of the trie of `members` (conv_id, turns as array of (id, words)), in ranges of about `width` keys: conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    distinct = settle(keys(members), "conversation-keys")
    ranges = max(1, -(-distinct.count() // width))
    cut = settle(distinct.repartitionByRange(ranges, "key").withColumn("part", F.spark_partition_id()), "key-ranges")
    # a row per range passes through this window
    borders = cut.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    along = Window.orderBy("part")
    beside = borders.withColumn("before", F.lag("high").over(along)).withColumn("after", F.lead("low").over(along))
    beside = beside.mapInArrow(_borders, "part int, left bigint, right bigint, goes_on boolean")
    # three numbers a range of `width` keys
    dealt = cut.join(F.broadcast(settle(beside, "range-borders")), "part")
    found = settle(dealt.groupBy("part").applyInArrow(_trees, OUT), "range-nodes")

    shared = found.where("node is not null").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.first("parent").alias("parent"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("ends").alias("ends"),
    )
    shared = settle(shared, "shared-nodes")
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends", "parent"]
    below = found.where("node is null and parent is not null").select(*columns).unionByName(shared.where("parent is not null").select(*columns))
    names = shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    if shared.count() <= BROADCAST_ROWS:
        named = below.join(F.broadcast(names), "parent")
    else:
        salted = names.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        named = below.withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS).cast("bigint"))).join(salted, ["parent", "salt"])
    inside = found.where("node is null and parent is null").select(*columns, "parent_conv_id")
    top = shared.where("parent is null").select(*columns, F.lit(None).cast("bigint").alias("parent_conv_id"))
    return inside.unionByName(top).unionByName(named.select(*columns, "parent_conv_id")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")
    )


def prefix_trie(conversations: DataFrame, width: int = RANGE) -> DataFrame:
    """The trie of all rebuilt conversations: one row for every distinct sequence of first turns (role, text), the empty one
    included.

    Of every node: conv_id (least of its members, the conversations that begin so), depth, the parent's conv_id, n_convs,
    n_children, n_leaves (nodes without children under it or itself), saved_tokens (words of the last turn that members after
    the first need not repeat, over its subtree), and the SHA-256 of the ids of members that end there.

    Null roles and texts are empty, a null turn number comes first, repeated numbers in the order of turn ids. Rows without
    conv_id are left out; other columns are ignored; an empty table gives no rows.
    """
    return trie(rebuild(timelines(conversations)), width)


#: The trie in DuckDB's SQL. The CRC is written out; a node is a list of turns.
TRIE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS u FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(u ORDER BY turn NULLS FIRST, u) AS turns FROM t GROUP BY conv_id),
hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295) % 4 AS h
  FROM own),
built AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns
  FROM hashed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
reached AS (SELECT conv_id, turns AS whole, unnest(range(0, len(turns) + 1)) AS depth FROM built),
member AS (SELECT conv_id, depth, whole[1:depth] AS node, len(whole) = depth AS ends FROM reached),
node AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(node[depth].t, '[^\x20\x09-\x0D]+')) END AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM member GROUP BY node, depth),
child AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
known AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM node n LEFT JOIN child c ON c.node = n.node),
above AS (SELECT *, unnest(range(0, depth + 1)) AS d FROM known),
under AS (
  SELECT node[1:d] AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM above GROUP BY 1)
SELECT k.conv_id::BIGINT AS conv_id, k.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, k.n_convs::BIGINT AS n_convs,
  k.n_children::BIGINT AS n_children, u.n_leaves::BIGINT AS n_leaves, u.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM known k JOIN under u ON u.node = k.node LEFT JOIN known p ON p.node = k.node[1:k.depth - 1] AND p.depth = k.depth - 1
"""
