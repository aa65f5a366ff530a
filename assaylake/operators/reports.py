"""Reports over the execution log, scores, quarantine, summaries and validated tables.

Listings are ordered as a reader wants them; ties are broken by name so that a report is reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import exact_mean, health, percent

# The health labels of the reports.
UPPER = ("HEALTHY", "WARNING", "CRITICAL")
TITLE = ("Healthy", "Warning", "Critical")
COLOUR = ("GREEN", "AMBER", "RED")

# The score buckets of the distribution report and their lower bounds.
BUCKETS = (
    (100, "1 - Perfect (100%)"),
    (80, "2 - Good (80-99%)"),
    (60, "3 - Fair (60-79%)"),
    (40, "4 - Poor (40-59%)"),
)
LAST_BUCKET = "5 - Critical (< 40%)"


def _rows() -> Column:
    return F.count(F.lit(1))


def _with(status: str) -> Column:
    return F.count_if(F.col("status") == status)


# --- scores -----------------------------------------------------------------------------------------------


def overall_score(scores: DataFrame, column: str = "overall_dq_score") -> DataFrame:
    return scores.agg(exact_mean(column, 1).alias("overall_dq_score"))


def scorecard(scores: DataFrame) -> DataFrame:
    """Datasets, worst first, with the share of rows that came through."""
    rate = F.when(
        F.col("total_records_in") > 0, F.round(F.col("total_records_out") * 100 / F.col("total_records_in"), 1)
    )
    return scores.select(
        "dataset_name",
        "overall_dq_score",
        "total_rules",
        "rules_passed",
        "rules_failed",
        "rules_errored",
        "total_records_in",
        "total_records_out",
        "records_quarantined",
        rate.alias("record_pass_rate_pct"),
        "scored_at",
    ).orderBy("overall_dq_score", "dataset_name")


# --- execution log ----------------------------------------------------------------------------------------


def by_rule_type(log: DataFrame) -> DataFrame:
    return log.groupBy("rule_type").agg(
        _rows().alias("total_executions"),
        _with("passed").alias("passed"),
        _with("failed").alias("failed"),
        _with("error").alias("errored"),
        percent(_with("passed"), _rows(), digits=1).alias("pass_rate_pct"),
        exact_mean("dq_score", 2).alias("avg_dq_score"),
        F.round(F.avg("execution_duration_ms"), 0).alias("avg_duration_ms"),
    )


def top_failing_rules(log: DataFrame, k: int | None = 10) -> DataFrame:
    """Failed rules by failure rate; all of them with ``k=None``."""
    failed = log.where("status = 'failed'").select(
        "rule_id",
        "rule_type",
        "dataset_name",
        "target_column",
        "severity",
        "dq_score",
        "failed_count",
        "total_records",
        (F.col("failed_count") * 100 / F.col("total_records")).alias("failure_rate_pct"),
    )
    ranked = failed.orderBy(F.desc("failure_rate_pct"), "dataset_name", "rule_id")
    return (ranked if k is None else ranked.limit(k)).withColumn(
        "failure_rate_pct", F.round("failure_rate_pct", 1)
    )


def heatmap(log: DataFrame) -> DataFrame:
    return (
        log.groupBy("dataset_name", "rule_type")
        .agg(exact_mean("dq_score", None).alias("avg"))
        .select(
            "dataset_name",
            "rule_type",
            F.round("avg", 1).alias("avg_score"),
            health(F.col("avg"), COLOUR).alias("health_status"),
        )
        .orderBy("dataset_name", "rule_type")
    )


def by_severity(log: DataFrame) -> DataFrame:
    return log.groupBy("severity").agg(
        _rows().alias("rule_count"),
        _with("passed").alias("rules_passed"),
        _with("failed").alias("rules_failed"),
        exact_mean("dq_score", 2).alias("avg_score"),
        F.sum("failed_count").alias("total_failed_records"),
    )


def rule_detail(log: DataFrame) -> DataFrame:
    return log.select(
        "dataset_name",
        "rule_id",
        "rule_type",
        "target_column",
        "severity",
        "enforcement_mode",
        "status",
        "total_records",
        "passed_count",
        "failed_count",
        "dq_score",
        "execution_duration_ms",
        F.when(F.col("dq_score").isNotNull(), health(F.col("dq_score"), UPPER)).alias("health_status"),
    ).orderBy("dataset_name", "dq_score", "rule_id")


def enforcement_effect(log: DataFrame) -> DataFrame:
    return log.groupBy("enforcement_mode", "dataset_name").agg(
        _rows().alias("rules_applied"),
        F.sum("failed_count").alias("total_failures_caught"),
        exact_mean("dq_score", 2).alias("avg_dq_score"),
    )


def sla_violations(log: DataFrame, threshold: float = 80.0) -> DataFrame:
    """Failed rules, worst first; an error-severity rule below the threshold breaks the service level."""
    broken = (F.col("dq_score") < threshold) & (F.col("severity") == "error")
    return (
        log.where("status = 'failed'")
        .select(
            "rule_id",
            "dataset_name",
            "target_column",
            "severity",
            "dq_score",
            "failed_count",
            "total_records",
            F.when(broken, "YES").otherwise("NO").alias("sla_violation"),
        )
        .orderBy("dq_score", "dataset_name", "rule_id")
    )


def execution_listing(log: DataFrame, run_id: str | None = None) -> DataFrame:
    rows = log if run_id is None else log.where(F.col("run_id") == run_id)
    return rows.select(
        "rule_id",
        "rule_type",
        "dataset_name",
        "target_column",
        "severity",
        "enforcement_mode",
        "status",
        "total_records",
        "passed_count",
        "failed_count",
        "dq_score",
    ).orderBy("dataset_name", "rule_id")


def framework_health(log: DataFrame, scores: DataFrame, quarantine_entries: Column | None = None) -> DataFrame:
    """Metric and value, one row each. Quarantine entries are the failures counted by the scores."""
    entries = F.sum("quarantine_entries") if quarantine_entries is None else quarantine_entries
    # One row per dataset before the counts, so that no distinct count is needed.
    per_dataset = log.groupBy("dataset_name").agg(
        _rows().alias("rules"), _with("passed").alias("passed"), _with("failed").alias("failed")
    )
    of_log = per_dataset.agg(
        _rows().alias("datasets"), F.sum("rules").alias("rules"), F.sum("passed").alias("passed"), F.sum("failed").alias("failed")
    )
    of_scores = scores.agg(entries.alias("entries"), exact_mean("overall_dq_score", 1).alias("score"))

    def lines(df: DataFrame, items: dict[str, Column]) -> DataFrame:
        rows = [F.struct(F.lit(k).alias("metric"), v.cast("string").alias("value")) for k, v in items.items()]
        return df.select(F.inline(F.array(*rows)))

    log_lines = lines(
        of_log,
        {
            "Total Datasets Scanned": F.col("datasets"),
            "Total Rules Executed": F.col("rules"),
            "Rules Passed": F.col("passed"),
            "Rules Failed": F.col("failed"),
        },
    )
    score_lines = lines(
        of_scores,
        {
            "Total Records Quarantined": F.col("entries"),
            "Average DQ Score": F.concat(F.col("score").cast("string"), F.lit("%")),
        },
    )
    return log_lines.unionByName(score_lines)


# --- quarantine -------------------------------------------------------------------------------------------


def quarantine_volume(quarantine: DataFrame, by: Sequence[str] = ("source_table",)) -> DataFrame:
    return quarantine.groupBy(*by).agg(_rows().alias("quarantined_count"))


def quarantine_breakdown(quarantine: DataFrame, with_reason: bool = True) -> DataFrame:
    by = ["source_table", "rule_type", "severity"] + (["quarantine_reason"] if with_reason else [])
    return quarantine_volume(quarantine, by).orderBy(F.desc("quarantined_count"), *by)


def quarantine_listing(quarantined: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quarantined rows of a validated table, worst score first."""
    return quarantined.select(
        *[F.col(f"`{c}`") for c in columns],
        F.col("_dq.failed_count").alias("_dq_failed_count"),
        F.col("_dq.row_score").alias("_dq_row_score"),
        F.concat_ws(", ", "_dq.failed_rules").alias("failed_rules"),
        "_quarantine_reason",
        "_quarantined_at",
    ).orderBy("_dq_row_score", *columns)


# --- summaries of row-level verdicts ----------------------------------------------------------------------


def kpi_counters(by_dataset: DataFrame, by_rule: DataFrame) -> DataFrame:
    """Overall score, records, rules and failures as metric and value."""
    records = by_dataset.agg(
        exact_mean("pass_rate_pct", 1).alias("score"), F.sum("total_records").cast("double").alias("records")
    )
    per_rule = by_rule.groupBy("rule_id").agg(F.sum("failed_count").alias("failed"))
    failures = per_rule.agg(_rows().cast("double").alias("rules"), F.sum("failed").cast("double").alias("failures"))

    def lines(df: DataFrame, items: dict[str, str]) -> DataFrame:
        rows = [F.struct(F.lit(k).alias("metric"), F.col(v).alias("value")) for k, v in items.items()]
        return df.select(F.inline(F.array(*rows)))

    return lines(records, {"overall_dq_score": "score", "total_records": "records"}).unionByName(
        lines(failures, {"total_rules": "rules", "total_failures": "failures"})
    )


def pass_rate_by_dataset(by_dataset: DataFrame) -> DataFrame:
    return by_dataset.select(
        "dataset_name",
        "total_records",
        "fully_clean_records",
        (F.col("total_records") - F.col("fully_clean_records")).alias("impacted_records"),
        "pass_rate_pct",
        "avg_row_score",
        "total_evaluations",
        F.round(F.col("fully_clean_records") * 100 / F.col("total_records"), 1).alias("clean_pct"),
    ).orderBy("pass_rate_pct", "dataset_name")


def clean_versus_quarantined(scores: DataFrame) -> DataFrame:
    """Row counts per dataset from the scores; no table is counted again."""
    share = F.when(
        F.col("total_records_in") > 0, F.round(F.col("total_records_out") * 100 / F.col("total_records_in"), 2)
    )
    return scores.select(
        F.col("dataset_name").alias("dataset"),
        F.col("total_records_out").alias("clean_rows"),
        F.col("quarantined_rows").alias("quarantine_rows"),
        F.col("total_records_in").alias("total_rows"),
        F.col("avg_row_score").alias("avg_dq_score"),
        share.alias("clean_pct"),
    )


def score_bucket(score: Column) -> Column:
    column = F.when(score >= BUCKETS[0][0], BUCKETS[0][1])
    for bound, name in BUCKETS[1:]:
        column = column.when(score >= bound, name)
    return column.otherwise(LAST_BUCKET)


def score_distribution(validated: DataFrame, dataset: str) -> DataFrame:
    return validated.groupBy(score_bucket(F.col("_dq.row_score")).alias("score_bucket")).agg(
        _rows().alias("row_count")
    ).select("score_bucket", F.lit(dataset).alias("dataset"), "row_count")


def score_stats(validated: DataFrame, dataset: str) -> DataFrame:
    score = F.col("_dq.row_score")
    return validated.agg(
        F.lit(dataset).alias("dataset"),
        exact_mean(score).alias("avg_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        _rows().alias("total_rows"),
    )


def rule_health(by_rule: DataFrame) -> DataFrame:
    rate = F.col("pass_rate_pct")
    return by_rule.select(
        "rule_id",
        "dataset_name",
        "total_records",
        "passed_count",
        "failed_count",
        "pass_rate_pct",
        health(rate, TITLE).alias("health_status"),
        health(rate, COLOUR).alias("health_colour"),
    ).orderBy("pass_rate_pct", "dataset_name", "rule_id")


def failures_by_type(by_rule: DataFrame, total_row: bool = False) -> DataFrame:
    """Evaluations and failures per rule type; ``total_row`` adds one for all types."""
    groups = by_rule.rollup("rule_type") if total_row else by_rule.groupBy("rule_type")
    total, good = F.sum("total_records"), F.sum("passed_count")
    out = groups.agg(
        total.alias("total_evaluations"),
        good.alias("passed_count"),
        F.sum("failed_count").alias("failed_count"),
        F.round(good * 100 / total, 2).alias("pass_rate_pct"),
    )
    return out.withColumn("rule_type", F.coalesce("rule_type", F.lit("ALL"))) if total_row else out


def rules_by_severity(by_rule: DataFrame) -> DataFrame:
    return by_rule.select("dataset_name", "rule_id", "pass_rate_pct", "failed_count", "severity").orderBy(
        "severity", "pass_rate_pct", "dataset_name", "rule_id"
    )


def rule_failure_ranking(by_rule: DataFrame) -> DataFrame:
    """Rules over all datasets, worst first."""
    total, good = F.sum("total_records"), F.sum("passed_count")
    return (
        by_rule.groupBy("rule_id")
        .agg(
            total.alias("total_records"),
            good.alias("passed"),
            F.sum("failed_count").alias("failed"),
            F.round(good * 100 / total, 2).alias("pass_rate"),
        )
        .orderBy("pass_rate", "rule_id")
    )


def worst_rows(validated: DataFrame, columns: Sequence[str], k: int | None = 50) -> DataFrame:
    """Rows that fail a rule, worst score first; all of them with ``k=None``."""
    failing = validated.where(~F.col("_dq.all_passed")).select(
        *[F.col(f"`{c}`") for c in columns],
        F.col("_dq.failed_count").alias("_dq_failed_count"),
        F.col("_dq.passed_count").alias("_dq_passed_count"),
        F.col("_dq.total_rules").alias("_dq_total_rules"),
        F.col("_dq.row_score").alias("_dq_row_score"),
        F.concat_ws(", ", "_dq.failed_rules").alias("failed_rules"),
        F.col("_dq.evaluated_at").alias("_dq_evaluated_at"),
    )
    ranked = failing.orderBy("_dq_row_score", *columns)
    return ranked if k is None else ranked.limit(k)
