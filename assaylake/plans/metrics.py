"""Rule and dataset metrics in one pass per dataset, and the execution log and scores made of them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import all_of, constant, exact_mean, instant, mean_of, percent, stable_id
from assaylake.model import Check, Rule
from assaylake.plans.compile import cannot_evaluate
from assaylake.plans.keyed import key_metrics
from assaylake.plans.verdicts import Verdicts
from assaylake.session import settle

LONG = "long"


@dataclass(frozen=True)
class Run:
    """What identifies one execution."""

    run_id: str
    dataset: str
    as_of: str | dt.datetime | None = None
    executed_by: str = "assaylake"
    duration_ms: int | None = None


_META = (
    "struct<position:int,rule_id:string,rule_name:string,rule_type:string,target_column:string,"
    "severity:string,enforcement_mode:string,error_message:string>"
)


def _meta(items: list[tuple[int, Rule, str | None]]) -> Column:
    entries = [
        {
            "position": position,
            "rule_id": rule.rule_id,
            "rule_name": rule.rule_name,
            "rule_type": rule.rule_type,
            "target_column": rule.column,
            "severity": rule.severity,
            "enforcement_mode": rule.enforcement,
            "error_message": error,
        }
        for position, rule, error in items
    ]
    return constant(entries, _META)


def _unfold(
    one_row: DataFrame, items: list[tuple[int, Rule, str | None]], totals: Column, passed: Column, broken: Column | None = None
) -> DataFrame:
    """One row of counters as one row per rule; ``totals``, ``passed`` and ``broken`` are arrays in the order of ``items``. A
    rule that could not be evaluated on some rows is an error and counts nothing."""
    none = F.array_repeat(F.lit(0).cast(LONG), len(items))
    zipped = F.arrays_zip(_meta(items).alias("m"), totals.alias("t"), passed.alias("p"), (none if broken is None else broken).alias("e"))
    unable = F.col("e") > 0
    return one_row.select(F.inline(zipped).alias("m", "t", "p", "e")).select(
        "m.position",
        "m.rule_id",
        "m.rule_name",
        "m.rule_type",
        "m.target_column",
        "m.severity",
        "m.enforcement_mode",
        F.when(unable, F.lit(0)).otherwise(F.col("t")).cast(LONG).alias("total_records"),
        F.when(unable, F.lit(0)).otherwise(F.col("p")).cast(LONG).alias("passed_count"),
        F.when(unable, cannot_evaluate(F.col("e"))).otherwise(F.col("m.error_message")).alias("error_message"),
    )


def rule_counts(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Total and passed rows per rule, all rules on all rows.

    One aggregate for all row rules and one key aggregate per key rule; no row is joined or exploded.
    """
    parts: list[DataFrame] = []
    row_checks = [(i, c) for i, c in enumerate(checks) if c.kind == "row"]
    if row_checks:
        counted = df.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(c.predicate).alias(f"p{i}") for i, c in row_checks],
            *[F.count_if(c.broken).alias(f"e{i}") for i, c in row_checks if c.broken is not None],
        )
        items = [(i, c.rule, None) for i, c in row_checks]
        passed = F.array(*[F.col(f"p{i}") for i, _ in row_checks])
        broken = F.array(*[F.lit(0).cast(LONG) if c.broken is None else F.col(f"e{i}") for i, c in row_checks])
        parts.append(_unfold(counted, items, F.array_repeat("n", len(items)), passed, broken))
    for i, check in enumerate(checks):
        if check.kind in ("unique", "reference"):
            counted = key_metrics(df, check)
            parts.append(_unfold(counted, [(i, check.rule, None)], F.array("total"), F.array("passed")))
    return _with_errors(df, parts, checks)


def _with_errors(df: DataFrame, parts: list[DataFrame], checks: Sequence[Check]) -> DataFrame:
    failed = [(i, c.rule, c.message or "error") for i, c in enumerate(checks) if c.kind == "error"]
    zeros = F.array_repeat(F.lit(0), max(len(failed), 1))
    one = df.sparkSession.range(1)
    if failed:
        parts = [*parts, _unfold(one, failed, zeros, zeros)]
    if not parts:
        return _unfold(one, [(0, Rule("", "", ""), None)], zeros, zeros).where("false")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@dataclass(frozen=True)
class Tally:
    """One row of counters per dataset, from a single aggregate over the verdict frame."""

    frame: DataFrame
    verdicts: Verdicts

    def rule_counts(self) -> DataFrame:
        v = self.verdicts
        items = [(i, c.rule, None) for i, c in enumerate(v.checks) if c.kind != "error"]
        parts = []
        if items:
            count = len(items)
            passed = F.array(*[F.col(f"p{k}") for k in range(count)])
            totals = F.array(*[F.col(f"t{k}") for k in range(count)]) if v.sequential else F.array_repeat("n", count)
            unable = v.broken()
            broken = F.array(*[F.col(f"e{k}") if k in unable else F.lit(0).cast(LONG) for k in range(count)])
            parts.append(_unfold(self.frame, items, totals, passed, broken))
        return _with_errors(v.frame, parts, v.checks)

    def stored(self) -> Tally:
        """The same with its one row in the shared folder, so that log, score and summaries read it and not the data."""
        return replace(self, frame=settle(self.frame, "tally"))

    def broken(self) -> dict[str, int]:
        """Ids of the rules that could not be evaluated on some rows, and on how many."""
        unable = self.verdicts.broken()
        if not unable:
            return {}
        row = self.frame.select(*[f"e{i}" for i in unable]).first()
        return {self.verdicts.rules[i].rule_id: row[f"e{i}"] for i in unable if row[f"e{i}"]}


def counters(verdicts: Verdicts) -> list[Column]:
    """Rows in ``n``, rows out ``n_clean``, rows passing all rules, sum of row scores, and per rule ``p*`` passed (``t*`` seen
    in sequential mode, ``e*`` not evaluated)."""
    v = verdicts
    count = len(v.rules)
    found = [F.count(F.lit(1)).alias("n"), F.count_if(v.clean()).alias("n_clean")]
    passed = [v.passed(i) for i in range(count)]
    found.append(F.count_if(all_of(passed)).alias("n_all_passed"))
    # Two decimals per row, so the sum is exact and does not depend on the order of partitions.
    found.append(F.sum(v.row_score().cast("decimal(18,2)")).alias("sum_row_score"))
    for i in range(count):
        seen = v.seen(i)
        if seen is None:
            found.append(F.count_if(passed[i]).alias(f"p{i}"))
        else:
            found.append(F.count_if(seen & passed[i]).alias(f"p{i}"))
            found.append(F.count_if(seen).alias(f"t{i}"))
    return [*found, *[F.count_if(rows).alias(f"e{i}") for i, rows in v.broken().items()]]


def tally(verdicts: Verdicts) -> Tally:
    """The counters by one aggregate over the verdict frame."""
    return Tally(verdicts.frame.agg(*counters(verdicts)), verdicts)


def average_row_score(n: Column) -> Column:
    return F.coalesce(mean_of(F.col("sum_row_score"), n), F.lit(100.0))


def execution_log(counts: DataFrame, run: Run) -> DataFrame:
    """Rule counts as rows of the execution log. Errors get no score; an empty input scores 100."""
    status = (
        F.when(F.col("error_message").isNotNull(), "error")
        .when(F.col("passed_count") < F.col("total_records"), "failed")
        .otherwise("passed")
    )
    score = F.when(F.col("error_message").isNull(), percent(F.col("passed_count"), F.col("total_records")))
    return counts.select(
        stable_id(run.run_id, run.dataset, F.col("rule_id")).alias("execution_id"),
        F.lit(run.run_id).alias("run_id"),
        "rule_id",
        "rule_type",
        F.lit(run.dataset).alias("dataset_name"),
        "target_column",
        "severity",
        "enforcement_mode",
        status.alias("status"),
        "total_records",
        "passed_count",
        (F.col("total_records") - F.col("passed_count")).alias("failed_count"),
        score.alias("dq_score"),
        "error_message",
        F.lit(run.duration_ms).cast(LONG).alias("execution_duration_ms"),
        instant(run.as_of).alias("executed_at"),
        F.lit(run.executed_by).alias("executed_by"),
    )


def dataset_score(counts: Tally, run: Run) -> DataFrame:
    """The score row of a run. The four scores differ in what they average, see README."""
    v = counts.verdicts
    able = len(v.rules)
    errors = len(v.checks) - able
    n = F.col("n")
    whole = [n, F.col("n_clean"), F.col("sum_row_score")]
    if able:
        totals = [F.col(f"t{i}") if v.sequential else n for i in range(able)]
        passes = [F.col(f"p{i}") for i in range(able)]
        # One line per rule, folded again: hundreds of rules stay a small expression.
        zipped = F.arrays_zip(F.array(*totals).alias("total"), F.array(*passes).alias("passed"))
        lines = counts.frame.select(*whole, F.inline(zipped).alias("total", "passed"))
    else:
        nothing = F.lit(None).cast(LONG)
        lines = counts.frame.select(nothing.alias("total"), nothing.alias("passed"), *whole)
    total, passed = F.col("total"), F.col("passed")
    score = F.when(total.isNotNull(), percent(passed, total))
    folded = lines.agg(
        F.max("n").alias("n"),
        F.max("n_clean").alias("n_clean"),
        F.max("sum_row_score").alias("sum_row_score"),
        F.count_if(passed == total).alias("good"),
        F.coalesce(exact_mean(score), F.lit(100.0)).alias("mean"),
        F.coalesce(F.sum(total), F.lit(0)).alias("seen"),
        F.coalesce(F.sum(passed), F.lit(0)).alias("passed"),
    )
    every = F.lit(len(v.checks))
    held = n - F.col("n_clean")
    return folded.select(
        stable_id(run.run_id, run.dataset).alias("score_id"),
        F.lit(run.run_id).alias("run_id"),
        F.lit(run.dataset).alias("dataset_name"),
        every.cast("int").alias("total_rules"),
        F.col("good").cast("int").alias("rules_passed"),
        (F.lit(able) - F.col("good")).cast("int").alias("rules_failed"),
        F.lit(errors).cast("int").alias("rules_errored"),
        F.col("mean").alias("overall_dq_score"),
        n.alias("total_records_in"),
        F.col("n_clean").alias("total_records_out"),
        held.alias("records_quarantined"),
        instant(run.as_of).alias("scored_at"),
        percent(F.col("good"), every).alias("rule_pass_ratio"),
        F.col("mean").alias("mean_rule_score"),
        percent(F.col("passed"), F.col("seen")).alias("pass_rate_pct"),
        average_row_score(n).alias("avg_row_score"),
        held.alias("quarantined_rows"),
        (F.col("seen") - F.col("passed")).alias("quarantine_entries"),
    )
