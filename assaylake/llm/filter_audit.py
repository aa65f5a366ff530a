"""Filter interaction audit: what every order of a set of filters removes, and which filter would have removed it anyway.

A document's failures are bits. Those that its own text decides come from one scan; that an equal text has a smaller id is
found by a left-semi join on hash, exact text and smaller id. The ids of both are united, and from then on only the counts
of bit combinations are needed: all orders and steps follow from them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.session import settle

#: Hashes whose copies are spread by salts, the most frequent ones, so any other is in at most one row of so many; and copies
#: that share a salt.
SPREAD, COPIES = 2000, 1024
#: Repeated hashes are broadcast up to this many, 24 bytes each.
BROADCAST_ROWS = 500_000

SPACE = " \t\n\x0b\f\r"

Failure = Callable[[Column, Column], Column]


def text_filters() -> dict[str, Failure]:
    """Failure conditions of the audited filters that look at a text (and the list of its words) alone."""
    return {
        "A": lambda text, words: F.size(words) < 200,
        "B": lambda text, words: 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": lambda text, words: 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
        "D": lambda text, words: text.rlike("[#$%&*|]"),
    }


def words_of(text: Column) -> Column:
    """The words of a text that is not null, cut at ASCII white space."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \t-\r]+"))


def copies(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """The rows (doc_id, text, hash and others) whose text a row with a smaller doc_id has as well, without the text.

    `hashes` holds doc_id and hash of the same rows. Only texts whose hash repeats are shuffled. The most frequent hashes are
    split by salts: their copies are dealt out, and the first copy, which is all that they are compared with, is repeated
    once for every salt.
    """
    counted = hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"))
    repeated = settle(counted.where("copies > 1"), "repeated-hashes")
    frequent = repeated.where(F.col("copies") > COPIES).orderBy(F.desc("copies"), "hash").limit(SPREAD)
    salts = F.broadcast(settle(frequent.select("hash", F.ceil(F.col("copies") / COPIES).alias("salts")), "frequent-hashes"))

    def salted(df: DataFrame) -> DataFrame:
        every = F.sequence(F.lit(0).cast("bigint"), F.coalesce("salts", F.lit(1)) - 1)
        return df.join(salts, "hash", "left").withColumn("salt", F.explode(every)).drop("salts")

    dealt = rows.join(salts, "hash", "left")
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.coalesce("salts", F.lit(1)))).drop("salts")
    groups = salted(repeated.select("hash", "least"))
    if repeated.count() <= BROADCAST_ROWS:
        groups = F.broadcast(groups)
    candidates = settle(dealt.join(groups, ["hash", "salt"]), "repeated-texts")
    first = candidates.groupBy("hash", "text").agg(F.min("doc_id").alias("first_id"))
    later, first = candidates.where(F.col("doc_id") > F.col("least")).alias("a"), salted(first).alias("b")
    same = (F.col("a.hash") == F.col("b.hash")) & (F.col("a.salt") == F.col("b.salt")) & (F.col("a.text") == F.col("b.text"))
    return later.join(first, same & (F.col("b.first_id") < F.col("a.doc_id")), "left_semi").drop("text", "salt", "least")


def combinations(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Failure],
    key: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """Rows per part and combination of failures (mask; bit k is the k-th filter, the next bit an earlier copy): n, and how
    many of them are labelled good and toxic."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        body.alias("text"),
        F.xxhash64(body).alias("hash"),
    )
    bits = [F.when(fails(F.col("text"), F.col("words")), 1 << k).otherwise(0) for k, fails in enumerate(filters.values())]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask + bit
    failed = settle(rows.withColumn("words", words_of(F.col("text"))).select("doc_id", "hash", "part", mask.alias("mask")), "text-failures")
    copied = copies(rows, failed.select("doc_id", "hash")).distinct()
    united = failed.withColumn("n", F.lit(1)).unionByName(copied.select("*", F.lit(1 << len(filters)).alias("mask"), F.lit(0).alias("n")))
    per_id = united.groupBy("doc_id", "hash", "part").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n"))
    # an id with many texts is folded before its labels are joined
    per_id = per_id.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    marks = labels.groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    marked = per_id.join(marks.where("doc_id is not null"), "doc_id", "left")
    return marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


def orders(names: str) -> list[tuple[str, int, int, int]]:
    """Every order of the filters: its name, step, bit of the step's filter and bits of the filters before it."""
    out = []
    for order in permutations(range(len(names))):
        name, before = "".join(names[k] for k in order), 0
        for step, k in enumerate(order, 1):
            out.append((name, step, 1 << k, before))
            before |= 1 << k
    return out


def audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Failure] | None = None,
    copy: str = "E",
    key: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """One row per part, order of the filters and step: rows kept after it, removed by it, redundant (failing its filter, but
    removed earlier), unique_fails (failing nothing else), good_lost and toxic_lost (removed with that label), and shapley:
    what its filter removes, summed over all orders.

    `filters` name by one letter each the failure conditions over text and words; `copy` names the one that a text fails
    which a row with a smaller id has as well. Null texts are empty and equal to each other; null parts and empty ones are
    one part. A row with a null id is counted, is no copy and makes none; rows of one id are no copies of each other. Labels
    that repeat an id count if any of them is set, those without id never. Other columns are ignored; an empty table gives
    no rows.

    Texts are read twice, and only those whose hash repeats are shuffled. What is united and aggregated is some 40 bytes a
    row; the orders see at most 2**filters rows of a part.
    """
    spark = docs.sparkSession
    filters = text_filters() if filters is None else dict(filters)
    names = "".join(filters) + copy
    plan = orders(names)
    counted = settle(combinations(docs, labels, filters, key, text, part), "failure-combinations")
    pairs = sorted({(bit, before) for _, _, bit, before in plan})
    bit, before, mask = F.col("bit"), F.col("before"), F.col("mask")
    cases = counted.withColumn("case", F.explode(F.array(*(F.struct(F.lit(b).alias("bit"), F.lit(a).alias("before")) for b, a in pairs))))
    cases = cases.select("part", "mask", "n", "good", "toxic", "case.bit", "case.before")
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0

    def total(rows: Column, value: Column) -> Column:
        return F.sum(F.when(rows, value).otherwise(0)).cast("bigint")

    n = F.col("n")
    measured = cases.groupBy("part", "bit", "before").agg(
        total(~fails & ~gone, n).alias("kept"),
        total(fails & ~gone, n).alias("removed"),
        total(fails & gone, n).alias("redundant"),
        total(mask == bit, n).alias("unique_fails"),
        total(fails & ~gone, F.col("good")).alias("good_lost"),
        total(fails & ~gone, F.col("toxic")).alias("toxic_lost"),
        # of all orders, a filter comes first among a document's failures in as many as it has failures
        total(fails, n * F.floor(F.lit(factorial(len(names))) / F.bit_count(mask))).alias("shapley"),
    )
    steps = spark.createDataFrame(plan, "filter_order string, step int, bit int, before int")
    return measured.join(F.broadcast(steps), ["bit", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


#: The audit of documents by labels in DuckDB's SQL.
AUDIT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
f AS (
  SELECT doc_id, part,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
x(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM x a, x b, x c, x d, x e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
  FROM o, (VALUES (1), (2), (3), (4), (5)) AS k(step)),
m AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (bit | before) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM m
"""
