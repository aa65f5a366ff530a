"""Rules judged by the version that was in force when a row happened."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import instant
from assaylake.model import Rule, RuleError, rule_from_row
from assaylake.plans.compile import cannot_evaluate, compile_rules

Moment = str | dt.date | dt.datetime | None


@dataclass(frozen=True)
class RuleVersion:
    """A version of a rule and when it was in force: from ``valid_from`` (None: ever) up to before ``valid_to`` (None: still)."""

    rule: Rule
    version: int
    valid_from: Moment = None
    valid_to: Moment = None


def versions_from(rows: Iterable[Mapping[str, Any]]) -> list[RuleVersion]:
    """Versions from rows of a rule history (see :func:`assaylake.operators.governance.rule_history`)."""
    return [RuleVersion(rule_from_row(r), int(r["version"]), r.get("valid_from"), r.get("valid_to")) for r in rows]


def _moment(value: Moment) -> Column:
    return instant(value.isoformat() if isinstance(value, dt.date) and not isinstance(value, dt.datetime) else value)


@dataclass(frozen=True)
class Judged:
    """A version with the rows that it judges and its verdict on them."""

    version: RuleVersion
    applies: Column
    passed: Column
    broken: Column | None
    message: str | None


def bind_versions(df: DataFrame, versions: Sequence[RuleVersion], time: str, as_of: Moment = None) -> list[Judged]:
    """Every version as a predicate of its own. Of a rule's versions the one that began last applies to a row, if it has not
    ended by then; rows without a time, and those of a time in which no version was in force, are not judged.

    No row is joined to the history: versions are edits by people, and the choice among them is a condition on the row's
    time. Key rules are refused, since their verdict depends on other rows.
    """
    refused = [v.rule.rule_id for v in versions if v.rule.rule_type in ("uniqueness", "referential_integrity")]
    if refused:
        raise RuleError(f"a version judges rows by themselves: {', '.join(refused)}")
    checks = compile_rules(df, [v.rule for v in versions], as_of=as_of)
    of_rule = defaultdict(list)
    for v, check in zip(versions, checks, strict=True):
        of_rule[v.rule.rule_id].append((v, check))
    at = F.col(f"`{time}`").cast("timestamp")
    found = []
    for group in of_rule.values():
        # ever comes before any date; of two that begin together the later version wins
        group.sort(key=lambda g: (g[0].valid_from is not None, str(g[0].valid_from or ""), g[0].version))
        for k, (v, check) in enumerate(group):
            later = [w for w, _ in group[k + 1 :]]
            applies = at.isNotNull() if v.valid_from is None else at >= _moment(v.valid_from)
            for w in later:  # began as well, so it is the one
                applies = applies & (F.lit(False) if w.valid_from is None else at < _moment(w.valid_from))
            if v.valid_to is not None:
                applies = applies & (at < _moment(v.valid_to))
            bad = check.kind == "error"
            found.append(Judged(v, F.coalesce(applies, F.lit(False)), F.lit(False) if bad else check.predicate, check.broken, check.message if bad else None))
    return found


def version_counts(df: DataFrame, versions: Sequence[RuleVersion], time: str, as_of: Moment = None) -> DataFrame:
    """Per rule and version: the rows it judges, those that pass, and its error if it has one; one pass over the rows."""
    judged = bind_versions(df, versions, time, as_of)
    if not judged:
        return df.sparkSession.createDataFrame([], "rule_id string, version int, total_records bigint, passed_count bigint, error_message string")
    broken = [F.lit(False) if j.broken is None else j.applies & j.broken for j in judged]
    counted = df.agg(
        *[F.count_if(j.applies).alias(f"t{i}") for i, j in enumerate(judged)],
        *[F.count_if(j.applies & j.passed).alias(f"p{i}") for i, j in enumerate(judged)],
        *[F.count_if(b).alias(f"e{i}") for i, b in enumerate(broken)],
    )
    rows = []
    for i, j in enumerate(judged):
        unable = (F.col(f"e{i}") > 0) | F.lit(j.message is not None)
        rows.append(
            F.struct(
                F.lit(j.version.rule.rule_id).alias("rule_id"),
                F.lit(j.version.version).alias("version"),
                F.when(unable, 0).otherwise(F.col(f"t{i}")).cast("bigint").alias("total_records"),
                F.when(unable, 0).otherwise(F.col(f"p{i}")).cast("bigint").alias("passed_count"),
                F.when(F.col(f"e{i}") > 0, cannot_evaluate(F.col(f"e{i}"))).otherwise(F.lit(j.message)).alias("error_message"),
            )
        )
    return counted.select(F.inline(F.array(*rows)))


def annotate_versions(df: DataFrame, versions: Sequence[RuleVersion], time: str, as_of: Moment = None) -> DataFrame:
    """The rows with ``_dq_versions``: rule, version and verdict of every version that judges them. Versions that cannot run,
    or cannot be evaluated on the row, are left out."""
    entries = []
    for j in bind_versions(df, versions, time, as_of):
        if j.message is None:
            applies = j.applies if j.broken is None else j.applies & ~j.broken
            entry = F.struct(F.lit(j.version.rule.rule_id).alias("rule_id"), F.lit(j.version.version).alias("version"), j.passed.alias("passed"))
            entries.append(F.when(applies, entry))
    none = F.array().cast("array<struct<rule_id:string,version:int,passed:boolean>>")
    return df.withColumn("_dq_versions", F.array_compact(F.array(*entries)) if entries else none)
