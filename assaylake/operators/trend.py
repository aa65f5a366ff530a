"""Scores over time, domain scores, and alert rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assaylake.functions.columns import exact_mean, mean_of


def daily_counts(df: DataFrame, passed: Column, day: Column, by: Sequence[str | Column]) -> DataFrame:
    """Rows and passed rows per group and day: the compact table all trends are made of."""
    return df.groupBy(*by, day.cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(passed).alias("passed")
    )


def score_trend(daily: DataFrame, by: Sequence[str], days: Sequence[int] = (7, 30)) -> DataFrame:
    """Daily score and its rolling mean over calendar days.

    The window runs over one row per group and day, never over data rows. The mean is that of the daily scores,
    so a busy day weighs no more than a quiet one.
    """
    scored = daily.withColumn("score", F.round(F.col("passed") * 100 / F.col("total"), 2))
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    exact = F.col("score").cast("decimal(18,2)")
    rolling = []
    for n in days:
        window = Window.partitionBy(*by).orderBy(number).rangeBetween(-(n - 1), 0)
        rolling.append(mean_of(F.sum(exact).over(window), F.count(exact).over(window)).alias(f"score_{n}d"))
    return scored.select(*by, "day", "total", "passed", "score", *rolling)


def domain_score(scores: DataFrame, domains: DataFrame) -> DataFrame:
    """Mean dataset score per domain and day. ``domains`` maps ``dataset_name`` to ``domain``."""
    return (
        scores.join(domains, "dataset_name")
        .groupBy("domain", F.col("scored_at").cast("date").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("datasets"),
            exact_mean("overall_dq_score").alias("domain_score"),
        )
    )


def quarantine_rate(scores: DataFrame) -> DataFrame:
    rows = F.col("total_records_in")
    return scores.select(
        "dataset_name",
        "run_id",
        "total_records_in",
        "quarantined_rows",
        F.when(rows > 0, F.col("quarantined_rows") * 100 / rows).otherwise(0.0).alias("quarantine_rate_pct"),
    )


def alerts(
    scores: DataFrame,
    log: DataFrame,
    warning: float = 95.0,
    error: float = 80.0,
    quarantine_pct: float = 10.0,
) -> DataFrame:
    """Alert rows: low scores, high quarantine rates, rules that could not run."""
    score = F.col("overall_dq_score")
    low = scores.where(score < warning).select(
        "dataset_name",
        F.lit("score").alias("alert"),
        F.when(score < error, "error").otherwise("warning").alias("level"),
        score.alias("value"),
        F.lit(None).cast("string").alias("rule_id"),
    )
    rate = quarantine_rate(scores).where(F.col("quarantine_rate_pct") > quarantine_pct)
    held = rate.select(
        "dataset_name",
        F.lit("quarantine_rate").alias("alert"),
        F.lit("warning").alias("level"),
        F.col("quarantine_rate_pct").alias("value"),
        F.lit(None).cast("string").alias("rule_id"),
    )
    broken = log.where("status = 'error'").select(
        "dataset_name",
        F.lit("rule_error").alias("alert"),
        F.lit("error").alias("level"),
        F.lit(None).cast("double").alias("value"),
        "rule_id",
    )
    return low.unionByName(held).unionByName(broken)
