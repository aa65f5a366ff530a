"""Rules on Structured Streaming inputs.

Row rules are stateless projections. Uniqueness and metrics keep state per event-time window and are bounded by a
watermark; referential integrity joins the stream with a static table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from assaylake.model import Rule, RuleError
from assaylake.operators import enforce, verdict
from assaylake.plans.compile import compile_rules
from assaylake.plans.verdicts import Verdicts, row_verdicts
from assaylake.streaming.running import per_rule, row_checks, window_counters

# A static reference up to this many keys and bytes is broadcast to the stream.
BROADCAST_KEYS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024


def stream_verdicts(stream: DataFrame, rules: Sequence[Rule], as_of: str | dt.datetime | None = None, refs=None) -> Verdicts:
    """Verdicts of row and reference rules on a stream.

    Rules that need other rows of the stream are refused; see :func:`windowed_duplicates`.
    """
    checks = compile_rules(stream, rules, refs, as_of)
    refused = [c.rule.rule_id for c in checks if c.kind == "unique"]
    if refused:
        raise RuleError(f"uniqueness needs a window on a stream: {', '.join(refused)}")
    able = [c for c in checks if c.kind != "error"]
    frame = stream
    for i, check in enumerate(able):
        if check.kind == "reference":
            frame = attach_reference(frame, check.keys[0], check.reference, f"__v{i}")
    frame = frame.select("*", *row_verdicts(able))
    return Verdicts(frame, tuple(stream.columns), tuple(c.rule for c in able), tuple(checks))


def attach_reference(stream: DataFrame, key: str, reference: DataFrame, name: str) -> DataFrame:
    """Does the key of a streamed row exist in a static table? ``reference`` has the column ``ref_key``.

    Text and numbers are compared as text, as in a batch. Beyond the broadcast limit rows with a NULL key, which match
    nothing, are spread by a digest instead of meeting in one task.
    """
    own = F.col(f"`{key}`")
    keys = reference.where(F.col("ref_key").isNotNull())
    if isinstance(stream.schema[key].dataType, T.StringType) != isinstance(reference.schema["ref_key"].dataType, T.StringType):
        own, keys = own.cast("string"), keys.select(F.col("ref_key").cast("string").alias("ref_key"))
    keys = keys.distinct()
    width = F.sum(F.octet_length(F.col("ref_key").cast("string")) + 16)
    size = keys.agg(F.count(F.lit(1)).alias("n"), width.alias("bytes")).first()
    found = keys.withColumn("__found", F.lit(True))
    if size["n"] <= BROADCAST_KEYS and (size["bytes"] or 0) <= BROADCAST_BYTES:
        joined = stream.join(F.broadcast(found), own == F.col("ref_key"), "left")
    else:
        plain = [F.col(f"`{f.name}`") for f in stream.schema if "map<" not in f.dataType.simpleString()]
        to = F.when(own.isNull(), F.xxhash64(*plain, F.spark_partition_id())).otherwise(F.xxhash64(own))
        found = found.withColumn("__from", F.xxhash64("ref_key"))
        joined = stream.withColumn("__to", to).join(found, (F.col("__to") == F.col("__from")) & (own == F.col("ref_key")), "left")
        joined = joined.drop("__to", "__from")
    return joined.withColumn(name, F.col("__found").isNotNull()).drop("ref_key", "__found")


def stream_validated(stream: DataFrame, rules: Sequence[Rule], as_of=None, refs=None) -> DataFrame:
    """The stream with its ``_dq`` struct."""
    return verdict.validated(stream_verdicts(stream, rules, as_of, refs), as_of)


def route(
    validated: DataFrame,
    write_clean: Callable[[DataFrame, int], None],
    write_quarantine: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Send each micro-batch to two sinks: clean rows and quarantined rows.

    A batch is evaluated once and kept while both sinks read it. The writers get the batch number, so that a
    batch that is replayed after a failure can replace its own output.
    """

    def both(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            write_clean(enforce.clean(batch), number)
            write_quarantine(enforce.quarantine(batch), number)
        finally:
            batch.unpersist()

    writer = validated.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once, until the available input is used up."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A writer for :func:`route`: one folder per batch, overwritten when the batch is replayed."""

    def write(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def window_metrics(
    stream: DataFrame,
    rules: Sequence[Rule],
    *,
    time: str,
    delay: str,
    window: Column,
    by: Sequence[str] = (),
    as_of=None,
) -> DataFrame:
    """Rows and passes per rule and window; rows later than ``delay`` are dropped by the watermark.

    ``window`` is ``F.window(...)`` (tumbling or sliding) or ``F.session_window(...)``. The same function serves a
    batch, where the watermark has no effect. The state holds one row per window and group. A stream that appends emits
    closed windows only; :mod:`assaylake.streaming.running` has the open ones and the late rows too. Rules that cannot be
    judged by the row alone, or cannot run, are refused.
    """
    checks = row_checks(stream, rules, as_of)
    counted = stream.withWatermark(time, delay).groupBy(window.alias("w"), *by).agg(*window_counters(checks))
    spans = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]
    return per_rule(counted.select(*spans, *[c for c in counted.columns if c != "w"]), checks, by)


def windowed_duplicates(stream: DataFrame, keys: Sequence[str], *, time: str, delay: str, size: str) -> DataFrame:
    """Keys that occur more than once in a tumbling window."""
    marked = stream.withWatermark(time, delay)
    counted = marked.groupBy(F.window(time, size).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n"
    )


def first_seen(stream: DataFrame, keys: Sequence[str], *, time: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
