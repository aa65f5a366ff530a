"""What goes back to the governance catalogue: one payload per executed rule, and a digest per dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import exact_mean


def feedback_payload(log: DataFrame, scores: DataFrame, run_id: str | None = None, sla: float = 80.0) -> DataFrame:
    """Rule results with the score of their dataset; ``payload`` holds the attributes as JSON."""
    executed = log if run_id is None else log.where(F.col("run_id") == run_id)
    of_dataset = scores.select("run_id", "dataset_name", F.col("overall_dq_score").alias("dataset_dq_score"))
    violated = F.when(F.col("severity") == "error", F.coalesce(F.col("dq_score") < sla, F.lit(False))).otherwise(False)
    rows = executed.join(of_dataset, ["run_id", "dataset_name"], "left").withColumn("sla_violation", violated)
    # The attribute names of the catalogue.
    attributes = F.struct(
        F.col("status").alias("Last Execution Status"),
        F.col("dq_score").alias("Last DQ Score"),
        F.col("failed_count").alias("Last Failed Count"),
        F.col("total_records").alias("Last Total Records"),
        F.col("executed_at").cast("string").alias("Last Execution Date"),
        F.col("dataset_dq_score").alias("Dataset DQ Score"),
        F.col("sla_violation").alias("SLA Violation"),
    )
    return rows.select(
        F.col("rule_id").alias("asset_id"),
        F.col("dataset_name").alias("dataset"),
        "status",
        "dq_score",
        "failed_count",
        "total_records",
        "dataset_dq_score",
        "sla_violation",
        F.to_json(attributes).alias("payload"),
    )


def feedback_digest(payload: DataFrame) -> DataFrame:
    """Updates, mean score and service-level violations per dataset."""
    return payload.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("updates"),
        exact_mean("dq_score", 1).alias("avg_dq_score"),
        F.count_if("sla_violation").alias("sla_violations"),
    )
