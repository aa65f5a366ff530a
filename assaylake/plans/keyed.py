"""Rules whose verdict belongs to a key: uniqueness and referential integrity.

Both start from ``key -> number of rows``. That aggregation combines on the map side, so a key that holds a
third of all rows costs one row per task. The metrics need nothing more. Row verdicts need the *bad* keys
(duplicates, orphans), which are few in healthy data: they are written to the shared folder, measured, and
joined back.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.functions.columns import all_of, any_of, total_of
from assaylake.model import Check
from assaylake.session import settle

# Bad keys up to this many rows and bytes are broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Beyond the broadcast limit rows with one of the most frequent keys don't enter the shuffle by key. A key outside the list
# holds at most 1/HOT_KEYS of the rows.
HOT_KEYS = 2_000
HOT_ROWS = 10_000
# In the list of hot keys longer texts stand as digests, so that it is bounded in bytes (2,000 x 1 KiB) as well.
HOT_KEY_BYTES = 1024
# Rows set aside are dealt over this many numbers, all others have number 0: a column that shrinks to next to nothing.
ASIDE = 1 << 16
# Key rules of one dataset whose bad keys are looked for at the same time.
PARALLEL_RULES = 4


def _key_names(check: Check) -> list[str]:
    return [f"__k{i}" for i in range(len(check.keys))]


def _null_key(columns: list[Column]) -> Column:
    return any_of([c.isNull() for c in columns])


def key_counts(df: DataFrame, check: Check) -> DataFrame:
    """One row per key: ``__k*``, ``n`` rows, and whether the key is ``bad``."""
    names = _key_names(check)
    keys = [c.alias(n) for c, n in zip(check.key_columns(), names)]
    return bad_key(df.select(*keys).groupBy(*names).agg(F.count(F.lit(1)).alias("n")), check)


def bad_key(counts: DataFrame, check: Check) -> DataFrame:
    """``counts`` (``__k*``, ``n`` and others) with the verdict of every key, ``bad``."""
    names, others = _key_names(check), [c for c in counts.columns if c not in _key_names(check)]
    null_key = _null_key([F.col(n) for n in names])
    if check.kind == "unique":
        bad = F.col("n") > 1
        if not check.null_equal:
            bad = bad & ~null_key
        return counts.select(*names, *others, bad.alias("bad"))

    ref = check.reference.where(F.col("ref_key").isNotNull())
    left, right = counts.schema[names[0]].dataType, ref.schema["ref_key"].dataType
    if isinstance(left, T.StringType) != isinstance(right, T.StringType):
        # Text against numbers: compare as text, so that text which is no number is an orphan, not an error.
        match_key, ref = F.col(names[0]).cast("string"), ref.select(F.col("ref_key").cast("string"))
    else:
        match_key = F.col(names[0])
    found = ref.distinct().withColumn("__found", F.lit(True))
    joined = counts.join(found, match_key == F.col("ref_key"), "left")
    return joined.select(*names, *others, F.col("__found").isNull().alias("bad"))


def key_metrics(df: DataFrame, check: Check) -> DataFrame:
    """One row ``total, passed`` for a key rule, without touching any column but the key."""
    counts = key_counts(df, check)
    total = F.coalesce(F.sum("n"), F.lit(0))
    failed = F.coalesce(F.sum(F.when(F.col("bad"), F.col("n"))), F.lit(0))
    return counts.agg(total.alias("total"), (total - failed).alias("passed"))


def _width(names: list[str]) -> Column:
    return total_of([F.coalesce(F.octet_length(F.col(n).cast("string")), F.lit(0)) for n in names])


@dataclass(frozen=True)
class BadKeys:
    """The keys a rule rejects and the most frequent keys (``hot``, with their verdict), both stored in the shared folder
    by one aggregation, and whether the rejected ones are few enough to broadcast."""

    check: Check
    stored: DataFrame
    hot: DataFrame
    broadcast: bool


def bad_keys(df: DataFrame, check: Check, among: Column | None = None) -> BadKeys:
    """Find and store the bad and the hot keys of a rule; the bad ones are counted and sized while they are written.

    ``among`` restricts which rows are counted (sequential mode).
    """
    counts = key_counts(df if among is None else df.where(among), check)
    names = _key_names(check)
    size = Observation()
    found = counts.where(F.col("bad") | (F.col("n") >= HOT_ROWS))
    rows, width = F.count_if("bad"), F.sum(F.when(F.col("bad"), _width(names) + 16))
    stored = settle(found.observe(size, rows.alias("rows"), width.alias("bytes")), "keys")
    seen = size.get
    few = seen["rows"] <= BROADCAST_KEYS and (seen["bytes"] or 0) <= BROADCAST_BYTES
    hot = stored.where(F.col("n") >= HOT_ROWS).orderBy(F.desc("n"), *names).limit(HOT_KEYS)
    return BadKeys(check, stored.where("bad").select(*names), hot.select(*names, "bad"), few)


def find_bad_keys(df: DataFrame, checks: list[Check]) -> list[BadKeys]:
    """:func:`bad_keys` of several rules over the same rows; the jobs overlap, each reads its own key columns."""
    if len(checks) < 2:
        return [bad_keys(df, c) for c in checks]
    with ThreadPoolExecutor(min(len(checks), PARALLEL_RULES)) as pool:
        work = inheritable_thread_target(df.sparkSession)(lambda c: bad_keys(df, c))
        return list(pool.map(work, checks))


def attach_key_verdict(df: DataFrame, found: BadKeys, name: str) -> DataFrame:
    """Add the boolean column ``name``: does the row pass the key rule? The rows are read once, whatever the join."""
    check, names = found.check, _key_names(found.check)
    columns = check.key_columns()
    if found.broadcast:
        flagged = found.stored.withColumn("__bad", F.lit(True))
        joined = df.join(F.broadcast(flagged), _same(columns, names, check.null_equal), "left")
        fails = F.col("__bad").isNotNull()
        return joined.withColumn(name, _verdict(fails, check, columns)).drop(*names, "__bad")

    return join_shuffled(set_aside(df, found, name), found, name)


def set_aside(df: DataFrame, found: BadKeys, name: str) -> DataFrame:
    """Add what :func:`join_shuffled` needs of a row beside its key. With several rules this goes before the first shuffle,
    since it looks at all columns of a row, which then need not go through it."""
    # Rows set aside go by their own digest, so that neither a hot nor a NULL key fills a task, and match nothing.
    spread = F.when(F.col("__aside"), F.pmod(_filler(df), F.lit(ASIDE)).cast("int") + 1).otherwise(F.lit(0))
    marked = _mark_hot(df, found).withColumn(f"{name}to", spread)
    return marked.withColumnRenamed("__hot_bad", f"{name}hot").drop("__aside")


def join_shuffled(marked: DataFrame, found: BadKeys, name: str) -> DataFrame:
    check, names = found.check, _key_names(found.check)
    columns = check.key_columns()
    # Always 0, but no literal: as one Spark would take it out of the join's keys, and rows set aside would go by theirs.
    never = F.pmod(F.hash(*[F.col(n) for n in names]), F.lit(1))
    flagged = found.stored.withColumn("__bad", F.lit(True)).withColumn("__from", never)
    same = (F.col(f"{name}to") == F.col("__from")) & _same(columns, names, check.null_equal)
    fails = F.coalesce(F.col(f"{name}hot"), F.col("__bad").isNotNull())
    judged = marked.join(flagged, same, "left").withColumn(name, _verdict(fails, check, columns))
    return judged.drop(*names, "__bad", f"{name}hot", f"{name}to", "__from")


def _filler(df: DataFrame) -> Column:
    """A digest of a row that a task which is run again computes anew: its columns, and its partition for equal rows."""
    plain = [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    return F.xxhash64(*plain, F.spark_partition_id())


def _verdict(fails: Column, check: Check, columns: list[Column]) -> Column:
    if check.null_equal:
        return ~fails
    # Rows with a NULL key match nothing; they pass uniqueness and fail referential integrity.
    return F.when(_null_key(columns), F.lit(check.kind == "unique")).otherwise(~fails)


def _short(column: Column, dtype: T.DataType) -> Column:
    """The key, or the digest of a long text, told apart by a character that no digest begins with."""
    if not isinstance(dtype, T.StringType):
        return column
    digest = F.concat(F.lit("\0"), F.sha2(column, 256))
    return F.when(F.octet_length(column) > HOT_KEY_BYTES, digest).otherwise(column)


def _mark_hot(df: DataFrame, found: BadKeys) -> DataFrame:
    """Mark the rows that must not enter a shuffle by key: ``__aside``, with their verdict ``__hot_bad``.

    These are rows with one of the HOT_KEYS most frequent keys, good or bad, whose verdict is broadcast, and rows
    with a NULL key. They are judged in place.
    """
    check, names = found.check, _key_names(found.check)
    types = [found.hot.schema[n].dataType for n in names]
    hot_names = [f"__h{i}" for i in range(len(names))]
    hot = found.hot.select(*[_short(F.col(n), t).alias(h) for n, h, t in zip(names, hot_names, types)], F.col("bad").alias("__hot_bad"))
    columns = check.key_columns()
    short = [_short(c, t) for c, t in zip(columns, types)]
    marked = df.join(F.broadcast(hot), _same(short, hot_names, check.null_equal), "left")
    aside = F.col("__hot_bad").isNotNull()
    if not check.null_equal:
        aside = aside | _null_key(columns)
    return marked.withColumn("__aside", aside).drop(*hot_names)


def _same(columns: list[Column], names: list[str], null_equal: bool) -> Column:
    return all_of([c.eqNullSafe(F.col(n)) if null_equal else c == F.col(n) for c, n in zip(columns, names)])
