"""Hard and soft enforcement: clean and quarantine splits, the quarantine log, circuit breaking."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import Key, constant, instant, masked, picked, record_key, stable_id
from assaylake.model import Rule
from assaylake.plans.metrics import Run
from assaylake.plans.verdicts import Verdicts


def _hard_failure() -> Column:
    return F.exists(F.col("_dq.results"), lambda r: (r["enforcement"] == "hard") & ~r["passed"])


def clean(df: DataFrame) -> DataFrame:
    """Validated rows that pass every hard rule; exact duplicates stay."""
    return df.where(~_hard_failure())


def quarantine(df: DataFrame, quarantined_at=None) -> DataFrame:
    """Validated rows that fail a hard rule, with all their failed rules as the reason."""
    return df.where(_hard_failure()).select(
        "*",
        F.concat_ws(", ", F.col("_dq.failed_rules")).alias("_quarantine_reason"),
        instant(quarantined_at).alias("_quarantined_at"),
    )


def flag_soft(df: DataFrame, name: str = "__dq_flag") -> DataFrame:
    """Soft enforcement: keep all rows, flag those that fail a soft rule."""
    failed = F.exists(F.col("_dq.results"), lambda r: (r["enforcement"] == "soft") & ~r["passed"])
    return df.withColumn(name, failed)


def split(v: Verdicts) -> tuple[DataFrame, DataFrame]:
    """Source rows (clean, quarantined), straight from the verdict columns."""
    columns = [F.col(f"`{c}`") for c in v.source]
    keep = v.clean()
    return v.frame.where(keep).select(*columns), v.frame.where(~keep).select(*columns)


def silver(v: Verdicts, run: Run, score: Column | float) -> DataFrame:
    """Clean rows with audit columns."""
    rows, _ = split(v)
    return rows.withColumns(
        {
            "_dq_run_id": F.lit(run.run_id),
            "_dq_score": score if isinstance(score, Column) else F.lit(score),
            "_dq_processed_at": instant(run.as_of),
        }
    )


def quarantine_log(
    v: Verdicts,
    run: Run,
    record: Key,
    mask: Mapping[str, str] | None = None,
) -> DataFrame:
    """One entry per failing (row, rule), hard and soft, with the record as JSON and its key, of one column or several.

    All rules are unfolded at once, so the plan does not grow a union branch per rule. ``mask`` hides personal
    columns (see :func:`assaylake.functions.columns.masked`) before they enter the payload.
    """
    hidden = mask or {}
    columns = [
        masked(F.col(f"`{c}`"), hidden[c]).alias(c) if c in hidden else F.col(f"`{c}`") for c in v.source
    ]
    # Filter before the payload is built: JSON is written for failing rows only.
    flagged = v.frame.select(*columns, record_key(record).alias("__key"), v.flags(failed=True).alias("__failed"))
    failing = flagged.where(F.exists("__failed", lambda f: f))
    entries = picked(constant([_entry(r) for r in v.rules], _ENTRY_TYPE), F.col("__failed"))
    # The payload also enters the id, so that rows that share a record key keep entries of their own.
    rows = failing.select(
        F.col("__key").alias("record_key"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in v.source])).alias("record_payload"),
        F.explode(entries).alias("e"),
    )
    return rows.select(
        stable_id(run.run_id, run.dataset, F.col("e.rule_id"), F.col("record_key"), F.col("record_payload")).alias(
            "quarantine_id"
        ),
        stable_id(run.run_id, run.dataset, F.col("e.rule_id")).alias("execution_id"),
        F.lit(run.run_id).alias("run_id"),
        F.col("e.rule_id").alias("rule_id"),
        F.col("e.rule_type").alias("rule_type"),
        F.lit(run.dataset).alias("source_table"),
        "record_key",
        "record_payload",
        F.concat(
            F.lit("Failed "), F.col("e.rule_type"), F.lit(" check on column '"), F.col("e.column"), F.lit("'")
        ).alias("quarantine_reason"),
        F.col("e.severity").alias("severity"),
        instant(run.as_of).alias("quarantined_at"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
        F.lit(None).cast("string").alias("resolution_action"),
    )


_ENTRY_TYPE = "struct<rule_id:string,rule_type:string,column:string,severity:string>"


def _entry(rule: Rule) -> dict[str, str]:
    return {"rule_id": rule.rule_id, "rule_type": rule.rule_type, "column": rule.column, "severity": rule.severity}


def gate(scores: DataFrame, threshold_pct: float = 50.0) -> DataFrame:
    """Circuit breaker: may a dataset be published? Not if more than ``threshold_pct`` of its rows fail hard."""
    rate = F.when(F.col("total_records_in") == 0, F.lit(0.0)).otherwise(
        F.col("quarantined_rows") * 100 / F.col("total_records_in")
    )
    return scores.select(
        "dataset_name",
        "run_id",
        rate.alias("failure_pct"),
        F.lit(float(threshold_pct)).alias("threshold_pct"),
        (rate <= threshold_pct).alias("publish"),
    )
