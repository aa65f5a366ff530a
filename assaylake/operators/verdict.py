"""Row annotation: the ``_dq`` struct, its flat view, and the long-form detail."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import Key, constant, instant, picked, record_key
from assaylake.model import Rule
from assaylake.plans.verdicts import Verdicts


# The fields of a rule result.
_ITEM_TYPE = (
    "struct<rule_id:string,rule_name:string,rule_type:string,column:string,severity:string,"
    "enforcement:string,passed:boolean>"
)


def _entries(rules: Sequence[Rule], passed: bool) -> Column:
    rows = [
        {
            "rule_id": r.rule_id,
            "rule_name": r.rule_name,
            "rule_type": r.rule_type,
            "column": r.column,
            "severity": r.severity,
            "enforcement": r.enforcement,
            "passed": passed,
        }
        for r in rules
    ]
    return constant(rows, _ITEM_TYPE)


def _results(rules: Sequence[Rule], flags: Column, keep: str) -> Column:
    """Result entries; each is picked from two constant arrays, no struct is built per row."""
    good, bad = _entries(rules, True), _entries(rules, False)
    if keep == "all":
        return F.transform(flags, lambda p, i: F.when(p, F.get(good, i)).otherwise(F.get(bad, i)))
    if keep == "failed":
        return picked(bad, flags, wanted=False)
    raise ValueError(f"results must be 'all' or 'failed', not '{keep}'")


def _verdict(rules: Sequence[Rule], flags: Column, evaluated_at: str | dt.datetime | None, results: str) -> Column:
    total = len(rules)
    ids = constant([r.rule_id for r in rules], "string")
    passed = F.size(picked(ids, flags))
    score = F.round(passed * 100 / total, 2) if total else F.lit(100.0)
    return F.struct(
        _results(rules, flags, results).alias("results"),
        picked(ids, flags).alias("passed_rules"),
        picked(ids, flags, wanted=False).alias("failed_rules"),
        passed.alias("passed_count"),
        (F.lit(total) - passed).alias("failed_count"),
        F.lit(total).alias("total_rules"),
        score.alias("row_score"),
        (passed == total).alias("all_passed"),
        instant(evaluated_at).alias("evaluated_at"),
    )


def validated(v: Verdicts, evaluated_at: str | dt.datetime | None = None, results: str = "all") -> DataFrame:
    """Source columns plus the ``_dq`` struct.

    The schema of ``_dq`` does not depend on the rules: a further rule lengthens arrays. ``results="failed"`` keeps
    the entries of failed rules only. Repeating seven fields per passed rule and row is most of the volume of a
    validated table; splits, listings and failure details need the failures alone.
    """
    source = [F.col(f"`{c}`") for c in v.source]
    flagged = v.frame.select(*source, v.flags().alias("__flags"))
    return flagged.select(*source, _verdict(v.rules, F.col("__flags"), evaluated_at, results).alias("_dq"))


def annotate(v: Verdicts, evaluated_at: str | dt.datetime | None = None) -> DataFrame:
    """Source columns plus flat ``_dq_<rule_id>`` booleans and ``_dq_*`` summary columns."""
    source = [F.col(f"`{c}`") for c in v.source]
    flagged = v.frame.select(*source, v.flags().alias("__flags"))
    flags = [F.get("__flags", F.lit(i)).alias(flag_name(r.rule_id)) for i, r in enumerate(v.rules)]
    dq = _verdict(v.rules, F.col("__flags"), evaluated_at, "failed")
    return flatten(flagged.select(*source, *flags, dq.alias("_dq")))


def flag_name(rule_id: str) -> str:
    return f"_dq_{rule_id.replace('-', '_')}"


# The fields of ``_dq`` that flat tables have.
_FLAT = (
    "passed_rules",
    "failed_rules",
    "passed_count",
    "failed_count",
    "total_rules",
    "row_score",
    "all_passed",
    "evaluated_at",
)


def flatten(df: DataFrame) -> DataFrame:
    """Replace ``_dq`` by flat ``_dq_*`` columns, the shape dashboards read."""
    others = [F.col(f"`{c}`") for c in df.columns if c != "_dq"]
    return df.select(*others, *[F.col(f"_dq.{f}").alias(f"_dq_{f}") for f in _FLAT])


def detail(df: DataFrame, dataset: str, primary_key: Key, failures_only: bool = False) -> DataFrame:
    """One row per (row, rule) from ``_dq.results``; ``primary_key`` is a column or several.

    This is rows x rules; summaries never need it. ``failures_only`` filters inside the array, before rows are
    multiplied.
    """
    results = F.col("_dq.results")
    if failures_only:
        results = F.filter(results, lambda r: ~r["passed"])
    source = F.col("_lineage.source.file_name") if "_lineage" in df.columns else F.lit(None).cast("string")
    rows = df.select(
        F.lit(dataset).alias("dataset_name"),
        record_key(primary_key).alias("primary_key_value"),
        F.explode(results).alias("rule"),
        F.col("_dq.row_score").alias("row_score"),
        F.col("_dq.all_passed").alias("all_passed"),
        F.col("_dq.evaluated_at").alias("evaluated_at"),
        source.alias("source_file"),
    )
    return rows.select(
        "dataset_name",
        "primary_key_value",
        F.col("rule.rule_id").alias("rule_id"),
        F.col("rule.rule_name").alias("rule_name"),
        F.col("rule.rule_type").alias("rule_type"),
        F.col("rule.column").alias("target_column"),
        F.col("rule.severity").alias("severity"),
        F.col("rule.enforcement").alias("enforcement"),
        F.col("rule.passed").alias("passed"),
        "row_score",
        "all_passed",
        "evaluated_at",
        "source_file",
    )


def detail_flat(df: DataFrame, rules: list[Rule], dataset: str, primary_key: Key) -> DataFrame:
    """The same long form from flat ``_dq_<rule_id>`` columns, keyed by the primary key."""
    results = _results(rules, F.array(*[F.col(flag_name(r.rule_id)) for r in rules]), "all")
    packed = df.select(
        *[F.col(f"`{k}`") for k in ([primary_key] if isinstance(primary_key, str) else primary_key)],
        F.struct(
            results.alias("results"),
            F.col("_dq_row_score").alias("row_score"),
            F.col("_dq_all_passed").alias("all_passed"),
            F.col("_dq_evaluated_at").alias("evaluated_at"),
        ).alias("_dq"),
    )
    return detail(packed, dataset, primary_key)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name of any number of per-dataset frames."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
