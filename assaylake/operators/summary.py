"""Summaries by rule and by dataset, from counters instead of exploded detail."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import instant, mean_of, percent, total_of
from assaylake.plans.metrics import Tally, average_row_score


def rule_summary(counts: DataFrame, dataset: str, digits: int | None = 2) -> DataFrame:
    """Per rule: rows, passed, failed, pass rate. ``counts`` is the long form of a run; errors are left out."""
    return counts.where(F.col("error_message").isNull()).select(
        F.lit(dataset).alias("dataset_name"),
        "rule_id",
        "rule_name",
        "rule_type",
        "severity",
        F.col("enforcement_mode").alias("enforcement"),
        "total_records",
        "passed_count",
        (F.col("total_records") - F.col("passed_count")).alias("failed_count"),
        percent(F.col("passed_count"), F.col("total_records"), digits=digits).alias("pass_rate_pct"),
    )


def dataset_summary(counts: Tally, dataset: str, evaluated_at: str | dt.datetime | None = None) -> DataFrame:
    """Per dataset: evaluations, pass rate, records, fully clean records, mean row score.

    Records are rows: rows that share a primary key count separately.
    """
    rules = len(counts.verdicts.rules)
    n = F.col("n")
    evaluations = n * rules
    passed = total_of([F.col(f"p{i}") for i in range(rules)]).cast("long")
    return counts.frame.select(
        F.lit(dataset).alias("dataset_name"),
        evaluations.alias("total_evaluations"),
        passed.alias("total_passed"),
        (evaluations - passed).alias("total_failed"),
        percent(passed, evaluations).alias("pass_rate_pct"),
        n.alias("total_records"),
        F.col("n_all_passed").alias("fully_clean_records"),
        average_row_score(n).alias("avg_row_score"),
        instant(evaluated_at).alias("evaluated_at"),
    )


def summaries_from_detail(detail: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(by dataset, by rule) from a stored detail table, for users who keep one.

    ``detail`` holds all rules of a row; the per-dataset figures first fold it back to one row per record.
    """
    ok = F.col("passed")
    records = detail.groupBy("dataset_name", "primary_key_value").agg(
        F.count(F.lit(1)).alias("evaluations"),
        F.count_if(ok).alias("passed"),
        F.bool_and("all_passed").alias("all_passed"),
        F.sum(F.col("row_score").cast("decimal(18,2)")).alias("score"),
        F.min("evaluated_at").alias("evaluated_at"),
    )
    evaluations, passed = F.sum("evaluations"), F.sum("passed")
    by_dataset = records.groupBy("dataset_name").agg(
        evaluations.alias("total_evaluations"),
        passed.alias("total_passed"),
        (evaluations - passed).alias("total_failed"),
        percent(passed, evaluations).alias("pass_rate_pct"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("all_passed").alias("fully_clean_records"),
        mean_of(F.sum("score"), evaluations).alias("avg_row_score"),
        F.min("evaluated_at").alias("evaluated_at"),
    )
    total, good = F.count(F.lit(1)), F.count_if(ok)
    by_rule = detail.groupBy("dataset_name", "rule_id", "rule_name", "rule_type", "severity", "enforcement").agg(
        total.alias("total_records"),
        good.alias("passed_count"),
        (total - good).alias("failed_count"),
        percent(good, total).alias("pass_rate_pct"),
    )
    return by_dataset, by_rule


def processing_summary(scores: DataFrame) -> DataFrame:
    """Bronze, silver and quarantine counts with the score, one row per run."""
    return scores.select(
        "dataset_name",
        "run_id",
        F.col("total_records_in").alias("bronze_count"),
        F.col("total_records_out").alias("silver_count"),
        F.col("quarantine_entries").alias("quarantine_count"),
        F.col("overall_dq_score").alias("dq_score"),
        "rules_passed",
        "rules_failed",
    )
