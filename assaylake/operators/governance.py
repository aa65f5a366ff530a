"""Care for rules and quarantined records: conflicts, schema drift, history, reprocessing, retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from assaylake.functions.columns import instant
from assaylake.model import Rule
from assaylake.plans.compile import References, compile_rules
from assaylake.plans.keyed import attach_key_verdict, bad_keys


def _number(name: str) -> Column:
    return F.get_json_object("params", f"$.{name}").try_cast("double")


# Bounds of the rule types that limit a value or its length.
_BOUNDS = {"range": ("min", "max"), "length": ("min_length", "max_length")}


def range_conflicts(resolved: DataFrame) -> DataFrame:
    """Bounds on one column that no value can meet.

    A set of intervals has no common point exactly if the greatest lower bound exceeds the least upper bound, so
    two aggregates per (dataset, column, type) find every contradiction; rules are never paired. The result names
    a rule on each side as witness.
    """
    low = F.coalesce(*[F.when(F.col("rule_type") == k, _number(a)) for k, (a, _) in _BOUNDS.items()])
    high = F.coalesce(*[F.when(F.col("rule_type") == k, _number(b)) for k, (_, b) in _BOUNDS.items()])
    bounds = resolved.where(F.col("rule_type").isin(*_BOUNDS)).select(
        "dataset_name", "target_column", "rule_type", "rule_id", low.alias("low"), high.alias("high")
    )
    key = ["dataset_name", "target_column", "rule_type"]
    # Smallest struct: the greatest lower bound first, equal bounds by rule id. Likewise for upper bounds.
    floor = F.min(F.when(F.col("low").isNotNull(), F.struct((-F.col("low")).alias("v"), F.col("rule_id").alias("rule"))))
    ceiling = F.min(F.when(F.col("high").isNotNull(), F.struct(F.col("high").alias("v"), F.col("rule_id").alias("rule"))))
    tightest = bounds.groupBy(*key).agg(
        F.count(F.lit(1)).alias("rules"), floor.alias("floor"), ceiling.alias("ceiling")
    )
    return tightest.select(
        *key,
        "rules",
        (-F.col("floor.v")).alias("floor"),
        F.col("ceiling.v").alias("ceiling"),
        F.col("floor.rule").alias("floor_rule"),
        F.col("ceiling.rule").alias("ceiling_rule"),
    ).where(F.col("floor") > F.col("ceiling"))


def value_conflicts(resolved: DataFrame) -> DataFrame:
    """Columns whose allowed-value lists have no value in common."""
    key = ["dataset_name", "target_column"]
    lists = resolved.where(F.col("rule_type") == "allowed_values").select(
        *key, "rule_id", F.array_distinct(F.from_json(F.get_json_object("params", "$.values"), "array<string>")).alias("values")
    )
    rules = lists.groupBy(*key).agg(F.count(F.lit(1)).alias("rules"))
    votes = lists.select(*key, F.explode("values").alias("value")).groupBy(*key, "value").agg(F.count(F.lit(1)).alias("n"))
    most = votes.groupBy(*key).agg(F.max("n").alias("shared_by"))
    return (
        rules.join(most, key, "left")
        .withColumn("shared_by", F.coalesce("shared_by", F.lit(0)))
        .where(F.col("shared_by") < F.col("rules"))
    )


def schema_columns(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset_name, column_name) of live tables, from their schemas."""
    spark = next(iter(datasets.values())).sparkSession
    rows = [(name, column) for name, df in datasets.items() for column in df.columns]
    return spark.createDataFrame(rows, "dataset_name string, column_name string")


def drifted_rules(resolved: DataFrame, live_columns: DataFrame) -> DataFrame:
    """Rules whose column has gone from the live schema."""
    live = live_columns.select("dataset_name", F.col("column_name").alias("target_column"))
    return resolved.join(live, ["dataset_name", "target_column"], "left_anti")


def deactivate_drifted(mappings: DataFrame, live_columns: DataFrame) -> DataFrame:
    """Mappings with ``is_active`` cleared where the column has gone."""
    live = live_columns.select("dataset_name", "column_name").withColumn("__live", F.lit(True))
    joined = mappings.join(live, ["dataset_name", "column_name"], "left")
    return joined.withColumn("is_active", F.col("is_active") & F.col("__live").isNotNull()).select(mappings.columns)


def rule_history(versions: DataFrame) -> DataFrame:
    """Versions with the time they were valid: a version ends where the next begins.

    The window holds the versions of one rule, which are edits by people; equal (rule, version) rows are folded
    first so that repeated loads of the same version do not pile up in it.
    """
    rest = [c for c in versions.columns if c not in ("rule_id", "version")]
    folded = versions.groupBy("rule_id", "version").agg(
        F.max(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("v")
    ).select("rule_id", "version", "v.*")
    following = F.lead("effective_from").over(Window.partitionBy("rule_id").orderBy("version"))
    return folded.withColumns({"valid_from": F.col("effective_from"), "valid_to": following}).withColumn(
        "is_current", F.col("valid_to").isNull()
    )


# --- quarantine lifecycle ---------------------------------------------------------------------------------


def restore(entries: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Quarantined records as rows again, from their JSON payload."""
    return entries.select(*keep, F.from_json("record_payload", schema).alias("r")).select(*keep, "r.*")


def reprocess(
    entries: DataFrame,
    schema: T.StructType,
    rules: Sequence[Rule],
    refs: References | None = None,
    as_of: str | dt.datetime | None = None,
    clean: DataFrame | None = None,
) -> DataFrame:
    """Re-evaluate open entries under the present rules; entries whose rule now passes are resolved.

    An entry belongs to one rule and is judged by that rule alone, so the record is restored in place and nothing
    is joined but key verdicts. Uniqueness is judged among the open entries of the rule and the rows of ``clean``, the table they
    would return to, so that no duplicate of a clean row is released. Entries whose rule is no
    longer given are resolved; entries whose rule cannot run stay open.
    """
    columns = entries.columns
    packed = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__entry")
    rows = entries.select(packed, F.from_json("record_payload", schema).alias("__r")).select("__entry", "__r.*")
    is_open, rule_id = F.col("__entry.resolved_at").isNull(), F.col("__entry.rule_id")
    passes = F.lit(True)
    checks = compile_rules(rows, rules, refs, as_of)
    for i, check in enumerate(checks):
        if check.kind == "error":
            verdict = F.lit(False)
        elif check.kind == "row":
            verdict = check.predicate
        else:
            of_rule = rows.where(is_open & (rule_id == check.rule.rule_id))
            if check.kind == "unique" and clean is not None:
                keys = [F.col(f"`{k}`") for k in check.keys]
                of_rule = of_rule.select(*keys).unionByName(clean.select(*keys))
            found = bad_keys(of_rule, check)
            rows = attach_key_verdict(rows, found, f"__v{i}")
            verdict = F.col(f"__v{i}")
        passes = F.when(rule_id == check.rule.rule_id, verdict).otherwise(passes)
    resolved = is_open & passes
    action = F.when(resolved, "reprocessed").otherwise(F.col("__entry.resolution_action"))
    at = F.when(resolved, instant(as_of)).otherwise(F.col("__entry.resolved_at"))
    entry = F.col("__entry").withField("resolution_action", action).withField("resolved_at", at)
    return rows.select(entry.alias("__entry")).select("__entry.*")


RESOLUTIONS = ("reprocessed", "deleted", "manually_fixed")


def resolve_entries(entries: DataFrame, decisions: DataFrame, at: str | dt.datetime | None = None) -> DataFrame:
    """Apply decisions ``(quarantine_id, action)``; ids must be unique, unknown actions are ignored."""
    chosen = decisions.where(F.col("action").isin(*RESOLUTIONS)).select("quarantine_id", "action")
    hit = F.col("action").isNotNull() & F.col("resolved_at").isNull()
    joined = entries.join(chosen, "quarantine_id", "left")
    return joined.withColumns(
        {
            "resolution_action": F.when(hit, F.col("action")).otherwise(F.col("resolution_action")),
            "resolved_at": F.when(hit, instant(at)).otherwise(F.col("resolved_at")),
        }
    ).select(entries.columns)


def retain(entries: DataFrame, days: int = 90, as_of: str | dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, expired): entries older than ``days`` expire."""
    limit = instant(as_of) - F.make_dt_interval(days=F.lit(days))
    fresh = F.col("quarantined_at") >= limit
    return entries.where(fresh), entries.where(~fresh)
