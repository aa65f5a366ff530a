"""Validation of a table that grows by batches, without reading its old rows again.

Counters of row rules add up over batches. Key rules keep the table ``key -> rows``, cut into buckets by a hash of the key:
a batch brings its own key counts, and only the buckets that it touches are merged and written anew. Every batch writes to
folders of its own and reads only those of earlier ones, so a batch that is run again replaces what it did.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Sequence
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.model import Check, Rule
from assaylake.plans.compile import References, compile_rules
from assaylake.plans.keyed import bad_key, key_counts
from assaylake.plans.metrics import rule_counts

# Buckets of a key table, of which a batch rewrites those that it touches. Files of a bucket are as many as its size asks for.
BUCKETS = 32

_COUNTS = "rule_id string, version string, total bigint, passed bigint, error string, batch bigint"
_SUMMARY = "bucket bigint, total bigint, failed bigint, batch bigint"


def fingerprint(rule: Rule) -> str:
    """Changes with whatever decides a rule's verdict; counters of another version are not added up with it."""
    body = json.dumps([rule.rule_type, rule.column, rule.params], sort_keys=True, default=str)
    return hashlib.sha256(body.encode()).hexdigest()[:16]


def _folder(state: str, rule: Rule) -> str:
    name = "".join(c if c.isalnum() or c in "-_" else f"~{ord(c):x}" for c in rule.rule_id)
    return f"{state}/keys/{name}/{fingerprint(rule)}"


def _stored(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """What batches (before one of them) have stored; nothing yet is an empty table."""
    try:
        df = spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], schema)
    return df if before is None else df.where(F.col("batch") < before)


def add_batch(
    df: DataFrame, rules: Sequence[Rule], state: str, batch: int, refs: References | None = None, as_of: str | dt.datetime | None = None
) -> None:
    """Judge the rows of a batch, numbered from 0 upwards, and add them to the state in the folder ``state``."""
    checks = compile_rules(df, rules, refs, as_of)
    for check in checks:
        if check.kind in ("unique", "reference"):
            _add_keys(df, check, state, batch)
    versions = F.create_map(*[F.lit(x) for r in rules for x in (r.rule_id, fingerprint(r))]) if rules else F.create_map()
    own = rule_counts(df, [c for c in checks if c.kind in ("row", "error")])
    counted = own.select(
        "rule_id", F.element_at(versions.cast("map<string,string>"), F.col("rule_id")).alias("version"), F.col("total_records").alias("total"),
        F.col("passed_count").alias("passed"), F.col("error_message").alias("error"),
    )
    counted.write.mode("overwrite").parquet(f"{state}/counts/batch={batch}")


def _add_keys(df: DataFrame, check: Check, state: str, batch: int) -> None:
    """Merge a batch's key counts with those of the buckets that it touches, and summarise these buckets."""
    spark, folder = df.sparkSession, _folder(state, check.rule)
    counts = key_counts(df, replace(check, kind="unique"))
    names = [n for n in counts.columns if n not in ("n", "bad")]
    counts = counts.select(*names, "n", F.pmod(F.xxhash64(*names), F.lit(BUCKETS).cast("bigint")).alias("bucket"))
    fresh = f"{folder}/fresh/batch={batch}"
    counts.write.mode("overwrite").parquet(fresh)
    counts = spark.read.schema(counts.schema).parquet(fresh)
    touched = [r["bucket"] for r in counts.select("bucket").distinct().collect()]
    last = _stored(spark, f"{folder}/summary", _SUMMARY, batch).groupBy("bucket").agg(F.max("batch").alias("batch"))
    # the latest version of each touched bucket, BUCKETS folders at most
    paths = [f"{folder}/merged/batch={r['batch']}/bucket={r['bucket']}" for r in last.where(F.col("bucket").isin(touched)).collect()]
    if paths:
        plain = counts.drop("bucket")
        held = spark.read.schema(plain.schema).parquet(*paths).withColumn("bucket", F.pmod(F.xxhash64(*names), F.lit(BUCKETS).cast("bigint")))
        counts = counts.unionByName(held.select(counts.columns)).groupBy(*names, "bucket").agg(F.sum("n").alias("n"))
    merged = f"{folder}/merged/batch={batch}"
    _write(counts.select(*names, "n", "bucket"), merged)
    summary = _summary(spark.read.schema(counts.select(*names, "n", "bucket").schema).parquet(merged), check)
    summary.write.mode("overwrite").parquet(f"{folder}/summary/batch={batch}")


def _write(counts: DataFrame, path: str) -> None:
    """A folder per bucket; adaptive execution splits large buckets over several tasks."""
    counts.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(path)


def _summary(merged: DataFrame, check: Check) -> DataFrame:
    """Rows and failed rows of every bucket."""
    judged = bad_key(merged, check)
    failed = F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0))
    return judged.groupBy("bucket").agg(F.sum("n").alias("total"), failed.alias("failed"))


def refresh_reference(df: DataFrame, rule: Rule, state: str, batch: int, refs: References) -> None:
    """Judge all keys seen so far against a reference that has changed, as of ``batch``; ``df`` gives the schema alone."""
    (check,) = compile_rules(df, [rule], refs)
    spark, folder = df.sparkSession, _folder(state, rule)
    last = _stored(spark, f"{folder}/summary", _SUMMARY, batch + 1).groupBy("bucket").agg(F.max("batch").alias("batch"))
    paths = [f"{folder}/merged/batch={r['batch']}/bucket={r['bucket']}" for r in last.collect()]
    counts = key_counts(df, replace(check, kind="unique")).drop("bad")
    names = [n for n in counts.columns if n != "n"]
    held = spark.read.schema(counts.schema).parquet(*paths).withColumn("bucket", F.pmod(F.xxhash64(*names), F.lit(BUCKETS).cast("bigint")))
    merged = f"{folder}/merged/batch={batch}"
    again = f"{folder}/fresh/batch={batch}-refreshed"
    held.select(*names, "n", "bucket").write.mode("overwrite").parquet(again)
    held = spark.read.schema(held.select(*names, "n", "bucket").schema).parquet(again)
    _write(held, merged)
    _summary(held, check).write.mode("overwrite").parquet(f"{folder}/summary/batch={batch}")


def counts_so_far(spark: SparkSession, rules: Sequence[Rule], state: str, upto: int | None = None) -> DataFrame:
    """Total and passed rows per rule over all batches (up to one of them), in the form of
    :func:`~assaylake.plans.metrics.rule_counts`, from which log and summaries follow.

    A rule that was an error in some batch, or could not be evaluated on some of its rows, is an error. A rule that has
    changed counts the batches since.
    """
    before = None if upto is None else upto + 1
    of = {r.rule_id: fingerprint(r) for r in rules}
    counts = _stored(spark, f"{state}/counts", _COUNTS, before)
    wanted = F.lit(False)
    for rule_id, version in of.items():
        wanted = F.when(F.col("rule_id") == rule_id, F.col("version") == version).otherwise(wanted)
    unable = F.max("error").alias("error_message")
    parts = [
        counts.where(wanted).groupBy("rule_id").agg(_unless(F.sum("total")).alias("total_records"), _unless(F.sum("passed")).alias("passed_count"), unable)
    ]
    for rule in rules:
        if rule.rule_type in ("uniqueness", "referential_integrity"):
            summary = _stored(spark, f"{_folder(state, rule)}/summary", _SUMMARY, before)
            latest = summary.groupBy("bucket").agg(F.max_by(F.struct("total", "failed"), "batch").alias("s"))
            total, failed = (F.coalesce(F.sum(f"s.{c}"), F.lit(0)) for c in ("total", "failed"))
            seen = latest.agg(total.alias("total_records"), (total - failed).alias("passed_count"), F.count(F.lit(1)).alias("buckets"))
            parts.append(seen.where("buckets > 0").select(F.lit(rule.rule_id).alias("rule_id"), "total_records", "passed_count", F.lit(None).cast("string").alias("error_message")))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    meta = spark.createDataFrame(
        [(i, r.rule_id, r.rule_name, r.rule_type, r.column, r.severity, r.enforcement) for i, r in enumerate(rules)],
        "position int, rule_id string, rule_name string, rule_type string, target_column string, severity string, enforcement_mode string",
    )
    zero = F.lit(0).cast("bigint")
    return meta.join(F.broadcast(found), "rule_id", "left").select(
        "position", "rule_id", "rule_name", "rule_type", "target_column", "severity", "enforcement_mode",
        F.coalesce("total_records", zero).alias("total_records"), F.coalesce("passed_count", zero).alias("passed_count"), "error_message",
    )


def _unless(total: Column) -> Column:
    """A counter of a rule that no batch found an error in."""
    return F.when(F.max("error").isNull(), total).otherwise(F.lit(0).cast("bigint"))
