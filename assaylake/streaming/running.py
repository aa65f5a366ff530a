"""Metrics of a stream that are current at any time, and complete when it ends.

Every micro-batch stores counters that add up, in a folder of its own that a replay overwrites; whoever reads them sums over
batches. No window waits for a watermark, no state is held between batches, and a frequent key costs one row per task and
batch. Rows behind the watermark are counted too, apart from the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assaylake.functions.columns import all_of
from assaylake.model import Check, Rule, RuleError
from assaylake.operators import enforce, verdict
from assaylake.plans.compile import References, compile_rules
from assaylake.plans.engine import run_rules
from assaylake.plans.metrics import Run
from assaylake.sources.tables import write_overwrite

Partial = Callable[[DataFrame, Column], DataFrame]
Sink = Callable[[DataFrame, int], None]

# Gap lengths in a time bucket: sessions are found within buckets first, then across their borders.
BUCKET = 1024


def row_checks(df: DataFrame, rules: Sequence[Rule], as_of: str | dt.datetime | None = None) -> list[Check]:
    """The rules bound to the rows of a window; those that need other rows, or cannot run, are refused."""
    checks = compile_rules(df, rules, as_of=as_of)
    refused = [c.rule.rule_id for c in checks if c.kind != "row"]
    if refused:
        raise RuleError(f"window metrics take row rules that run only: {', '.join(refused)}")
    return checks


def window_counters(checks: Sequence[Check]) -> list[Column]:
    """``total``, ``clean``, per rule ``p*`` passed and ``e*`` rows on which a rule by a user cannot be evaluated."""
    broken = [F.lit(False) if c.broken is None else c.broken for c in checks]
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(all_of([c.predicate for c in checks])).alias("clean"),
        *[F.count_if(c.predicate).alias(f"p{i}") for i, c in enumerate(checks)],
        *[F.count_if(b).alias(f"e{i}") for i, b in enumerate(broken)],
    ]


def per_rule(counted: DataFrame, checks: Sequence[Check], by: Sequence[str]) -> DataFrame:
    """One row per window and rule from a window's counters. A rule that could not be evaluated on some rows of a window has
    no ``passed`` there, and the window no ``clean``; ``errors`` says on how many."""
    unable = [F.col(f"e{i}") > 0 for i in range(len(checks))]
    rows = [
        F.struct(
            F.lit(c.rule.rule_id).alias("rule_id"),
            F.when(~unable[i], F.col(f"p{i}")).alias("passed"),
            F.col(f"e{i}").alias("errors"),
        )
        for i, c in enumerate(checks)
    ]
    clean = F.when(~F.greatest(F.lit(False), F.lit(False), *unable), F.col("clean")).alias("clean")
    return counted.select("window_start", "window_end", *by, "total", clean, F.inline(F.array(*rows)))


# --- partial counters of a batch ---------------------------------------------------------------------------


def window_partial(window: Column, time: str, by: Sequence[str], counters: Sequence[Column]) -> Partial:
    """Counters per tumbling or sliding window. A window that ends at the watermark or before it is late."""

    def partial(rows: DataFrame, watermark: Column) -> DataFrame:
        counted = rows.groupBy(window.alias("w"), *by).agg(*counters, F.max(time).alias("latest"))
        ends = F.col("w.end")
        late = F.coalesce(ends <= watermark, F.lit(False)).alias("late")
        others = [c for c in counted.columns if c != "w"]
        return counted.select(F.col("w.start").alias("window_start"), ends.alias("window_end"), *others, late)

    return partial


def slot_partial(time: str, gap: str, by: Sequence[str], counters: Sequence[Column]) -> Partial:
    """Counters per key and slot of one gap's length, of which all rows belong to one session. A row whose own session would
    end at the watermark or before it is late."""

    def partial(rows: DataFrame, watermark: Column) -> DataFrame:
        at = F.col(time)
        late = F.coalesce(at + F.expr(f"INTERVAL {gap}") <= watermark, F.lit(False))
        slotted = rows.where(at.isNotNull()).withColumns({"late": late, "slot": F.floor(F.unix_micros(at) / _micros(gap))})
        return slotted.groupBy(*by, "slot", "late").agg(*counters, F.min(time).alias("earliest"), F.max(time).alias("latest"))

    return partial


def _micros(gap: str) -> Column:
    return F.expr(f"CAST(CAST(INTERVAL {gap} AS INTERVAL DAY TO SECOND) AS INTERVAL SECOND)").cast("decimal(18,6)").cast("double") * 1e6


# --- running a stream --------------------------------------------------------------------------------------


def follow(stream: DataFrame, partial: Partial, *, delay: str, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Store the partial counters of every micro-batch under ``path``.

    The watermark of a batch lies ``delay`` behind the latest time of the batches before it, which is stored with them; so a
    replayed batch judges lateness as it did the first time.
    """
    empty = stream.sparkSession.createDataFrame([], stream.schema)
    none = F.lit(None).cast("timestamp")
    write_overwrite(partial(empty, none), f"{path}/counts/batch=-1")
    write_overwrite(empty.select(none.alias("latest")), f"{path}/marks/batch=-1")

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema("latest timestamp, batch bigint").parquet(f"{path}/marks").where(F.col("batch") < number)
        micros = before.agg(F.unix_micros(F.max("latest")).alias("latest")).first()["latest"]
        seen = F.timestamp_micros(F.lit(micros).cast("bigint"))
        watermark = seen - F.expr(f"INTERVAL {delay}")
        counts = partial(batch, watermark)
        folder = f"{path}/counts/batch={number}"
        counts.write.mode("overwrite").parquet(folder)
        latest = spark.read.schema(counts.schema).parquet(folder).agg(F.max("latest").alias("latest"))
        write_overwrite(latest.select(F.greatest(F.col("latest"), seen).alias("latest")), f"{path}/marks/batch={number}")

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stored(spark: SparkSession, path: str, late: bool = False) -> DataFrame:
    """The partial counters of all batches so far, those in time or the late ones."""
    schema = spark.read.parquet(f"{path}/counts/batch=-1").schema
    return spark.read.schema(schema).parquet(f"{path}/counts").where(F.col("late") == late)


def _summed(df: DataFrame) -> list[Column]:
    """Sums of the counters among the columns of partial rows."""
    names = [c for c in df.columns if c in ("total", "clean") or (c[0] in "pe" and c[1:].isdigit())]
    return [F.sum(c).alias(c) for c in names]


def window_totals(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counters of windows, whole so far."""
    return parts.groupBy("window_start", "window_end", *by).agg(*_summed(parts))


def duplicates(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in a window."""
    counted = window_totals(parts, keys).where(F.col("total") > 1)
    return counted.select("window_start", "window_end", *keys, F.col("total").alias("n"))


def sessions(slots: DataFrame, by: Sequence[str], gap: str, bucket: int = BUCKET) -> DataFrame:
    """Counters of sessions: a row that comes less than ``gap`` after another of its key joins its session.

    Slots are joined within time buckets first, then the first and last sessions of neighbouring buckets. So a window holds
    at most ``bucket`` rows, and then two rows a bucket of one key, however many rows that key has.
    """
    sums, apart = _summed(slots), F.expr(f"INTERVAL {gap}")
    rows = slots.groupBy(*by, "slot").agg(*sums, F.min("earliest").alias("earliest"), F.max("latest").alias("latest"))

    def joined(df: DataFrame, key: list[str], order: list[str], name: str) -> DataFrame:
        along = Window.partitionBy(*key).orderBy(*order)
        before = F.lag("latest").over(along)
        fresh = F.when(before.isNull() | (F.col("earliest") >= before + apart), 1).otherwise(0)
        return df.withColumn("fresh", fresh).withColumn(name, F.sum("fresh").over(along.rowsBetween(Window.unboundedPreceding, 0)))

    def merged(df: DataFrame, key: list[str]) -> DataFrame:
        return df.groupBy(*key).agg(*_summed(df), F.min("earliest").alias("earliest"), F.max("latest").alias("latest"))

    rows = rows.withColumn("bucket", F.floor(F.col("slot") / bucket))
    near = [*by, "bucket"]
    islands = merged(joined(rows, near, ["slot"], "island"), [*near, "island"])
    islands = islands.withColumn("islands", F.max("island").over(Window.partitionBy(*near)))
    border = (F.col("island") == 1) | (F.col("island") == F.col("islands"))
    across = merged(joined(islands.where(border), list(by), ["bucket", "island"], "chain"), [*by, "chain"])
    columns = [*by, *[c for c in across.columns if c not in (*by, "chain")]]
    found = islands.where(~border).select(*columns).unionByName(across.select(*columns))
    return found.withColumns({"window_start": F.col("earliest"), "window_end": F.col("latest") + apart}).drop("earliest", "latest")


def session_metrics(df: DataFrame, rules: Sequence[Rule], *, time: str, gap: str, by: Sequence[str], as_of=None) -> DataFrame:
    """Rows and passes per rule and session of a batch."""
    checks = row_checks(df, rules, as_of)
    slots = slot_partial(time, gap, by, window_counters(checks))(df, F.lit(None).cast("timestamp"))
    return per_rule(sessions(slots, by, gap), checks, by)


# --- row verdicts batch by batch ---------------------------------------------------------------------------


def judge_batches(
    stream: DataFrame,
    rules: Sequence[Rule],
    run: Run,
    sinks: Mapping[str, Sink],
    checkpoint: str,
    refs: References | None = None,
    results: str = "all",
    available_now: bool = True,
) -> StreamingQuery:
    """Judge every micro-batch as a batch is judged, and hand it to ``sinks``: any of ``validated``, ``clean``, ``quarantine``,
    ``log`` and ``score``, called with a frame and the batch's number, so that a replay can replace its own output.

    A rule that cannot be evaluated on some row is an error of its batch, and the others run. Keys of references are
    counted per batch, so a frequent key does not meet in one task. Uniqueness is refused: it needs a window, see
    :func:`duplicates`.
    """
    refused = [r.rule_id for r in rules if r.rule_type == "uniqueness"]
    if refused:
        raise RuleError(f"uniqueness needs a window on a stream: {', '.join(refused)}")

    def judge(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            result = run_rules(batch, rules, replace(run, run_id=f"{run.run_id}-{number}"), refs)
            checked = verdict.validated(result.verdicts, run.as_of, results)
            frames = {
                "validated": lambda: checked,
                "clean": lambda: enforce.clean(checked),
                "quarantine": lambda: enforce.quarantine(checked, run.as_of),
                "log": lambda: result.log,
                "score": lambda: result.score,
            }
            for name, sink in sinks.items():
                sink(frames[name](), number)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
