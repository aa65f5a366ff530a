"""Binding rules to a DataFrame: predicates, key checks, and isolation of rules that cannot run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.functions.columns import all_of, instant
from assaylake.functions.predicates import Target, build_predicate, listed, need, row_rule_types
from assaylake.model import Check, Reference, Rule, RuleError

# Rule types whose predicates fail on no row once literals and patterns have been tried.
SAFE_TYPES = frozenset({"not_null", "range", "regex", "allowed_values", "length", "freshness"})

References = Mapping[str, Reference | DataFrame]


def rule_types() -> tuple[str, ...]:
    """All rule types that can be compiled."""
    return (*row_rule_types(), "uniqueness", "referential_integrity")


def _columns(df: DataFrame, names: Sequence[str]) -> None:
    known = set(df.columns)
    for name in names:
        if name not in known:
            raise RuleError(f"column '{name}' not found")


def _unique(df: DataFrame, rule: Rule) -> Check:
    columns = list(listed(rule.params, "columns", "uniqueness")) if rule.params.get("columns") else [rule.column]
    scope = rule.params.get("scope", "table")
    if scope == "partition":
        columns = [*listed(rule.params, "partition_by", "uniqueness"), *columns]
    elif scope != "table":
        raise RuleError(f"uniqueness scope '{scope}' is not known")
    keys = tuple(dict.fromkeys(columns))
    _columns(df, keys)
    return Check(
        rule,
        "unique",
        keys=keys,
        null_equal=rule.params.get("nulls") == "equal",
        digest=bool(rule.params.get("digest", False)),
    )


def _reference(df: DataFrame, rule: Rule, refs: References) -> Check:
    table = need(rule.params, "ref_table", "referential_integrity")
    _columns(df, [rule.column])
    # A reference given for the rule itself wins over one for the table name.
    ref = refs.get(rule.rule_id, refs.get(table))
    if ref is None:
        raise RuleError(f"reference table '{table}' is not available")
    frame = ref.frame if isinstance(ref, Reference) else ref
    column = rule.params.get("ref_column") or (ref.column if isinstance(ref, Reference) else None) or rule.column
    if column not in frame.columns:
        raise RuleError(f"column '{column}' not found in reference table '{table}'")
    return Check(rule, "reference", keys=(rule.column,), reference=frame.select(F.col(column).alias("ref_key")))


def _row(df: DataFrame, rule: Rule, as_of: Column) -> Check:
    if rule.rule_type == "custom_sql" and rule.column not in df.columns:
        # The expression names its own columns; the target column is only a label.
        column, dtype = F.lit(None), None
    else:
        _columns(df, [rule.column])
        column, dtype = F.col(f"`{rule.column}`"), df.schema[rule.column].dataType
    predicate = build_predicate(rule.rule_type, rule.params, Target(column, dtype, as_of, rule.column))
    if rule.rule_type in SAFE_TYPES:
        return Check(rule, "row", F.coalesce(predicate, F.lit(False)))
    verdict = _tried(df, predicate, rule.column)
    return Check(rule, "row", F.coalesce(verdict == F.lit("true").cast("binary"), F.lit(False)), broken=verdict.isNull())


def _tried(df: DataFrame, predicate: Column, name: str) -> Column:
    """The predicate as text in bytes, NULL on rows where evaluating it raises (a bad cast, a division by zero).

    The ``try_`` function swallows what is raised inside it, but not in parts that Spark has taken out because several rules
    share them. Spark takes nothing out of a branch of which it does not know that it is always reached; the branch's
    condition holds on every row.
    """
    known = {f.name: f.dataType for f in df.schema if isinstance(f.dataType, T.AtomicType) and f.dataType.typeName() != "variant"}
    text = F.try_to_binary(F.coalesce(predicate.cast("string"), F.lit("null")), F.lit("utf-8"))
    if not known:
        return text
    field = name if name in known else next(iter(known))
    value = F.col(f"`{field}`")
    if isinstance(known[field], (T.StringType, T.BinaryType)):
        return F.when(F.coalesce(F.octet_length(value), F.lit(0)) >= 0, text)
    return F.when(F.hash(value) >= F.lit(-(2**31)), text)


def in_error(checks: Sequence[Check], rows: Mapping[str, int]) -> list[Check]:
    """The checks, those that could not be evaluated on some ``rows`` (by rule id) turned into errors."""
    return [replace(c, kind="error", broken=None, message=cannot_evaluate(rows[c.rule.rule_id])) if rows.get(c.rule.rule_id) else c for c in checks]


def cannot_evaluate(rows: int | Column) -> str | Column:
    if isinstance(rows, Column):
        return F.concat(F.lit("cannot be evaluated on "), rows.cast("string"), F.lit(" rows"))
    return f"cannot be evaluated on {rows} rows"


def compile_rule(df: DataFrame, rule: Rule, refs: References | None = None, as_of: Column | None = None) -> Check:
    """Bind one rule; a rule that cannot run comes back with kind ``error`` and a message."""
    as_of = instant(None) if as_of is None else as_of
    try:
        if rule.rule_type == "uniqueness":
            return _unique(df, rule)
        if rule.rule_type == "referential_integrity":
            return _reference(df, rule, refs or {})
        return _row(df, rule, as_of)
    except (RuleError, TypeError, ValueError, AnalysisException) as problem:
        return Check(rule, "error", message=str(problem))


def _failed(check: Check, problem: Exception) -> Check:
    return Check(check.rule, "error", message=str(problem).split("\n")[0])


def _isolate(checks: list[Check], attempt: Callable[[list[Check]], object]) -> list[Check]:
    """Try all rules together; halve the list until those that Spark refuses are found."""
    if not checks:
        return []
    try:
        attempt(checks)
        return checks
    except (PySparkException, Py4JJavaError) as problem:
        if len(checks) == 1:
            return [_failed(checks[0], problem)]
        middle = len(checks) // 2
        return _isolate(checks[:middle], attempt) + _isolate(checks[middle:], attempt)


def _analyse(df: DataFrame) -> Callable[[list[Check]], object]:
    """``where`` refuses aggregates and window functions. Literals and patterns of the rule types that cannot fail on rows
    are tried on one row of plain values, which the driver evaluates without a job."""
    local = df.sparkSession.sql("SELECT * FROM VALUES (0) AS t(`0`)")
    blank = local.select(*[_plain(f.dataType).alias(f.name) for f in df.schema])

    def attempt(checks: list[Check]) -> object:
        df.where(all_of([c.predicate for c in checks])).schema
        for c in checks:
            if c.rule.rule_type == "custom_sql":
                _no_subquery(df, c)
        safe = [c.predicate.alias(f"p{i}") for i, c in enumerate(checks) if c.rule.rule_type in SAFE_TYPES]
        return blank.select(*safe).collect() if safe else None

    return attempt


def _plain(dtype: T.DataType) -> Column:
    """A value of the type that comparisons really look at; NULL for types without an obvious one."""
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(dtype)
    return F.lit("" if isinstance(dtype, (T.StringType, T.BinaryType)) else None).cast(dtype)


def _no_subquery(df: DataFrame, check: Check) -> None:
    """A rule looks at one row; its parsed expression tells a subquery from FROM in EXTRACT or TRIM."""
    plan = df.select(check.predicate.alias("p"))._jdf.queryExecution().analyzed()
    if plan.subqueriesAll().nonEmpty():
        raise AnalysisException("custom_sql must not contain a subquery")


def compile_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    refs: References | None = None,
    as_of: str | dt.datetime | None = None,
) -> list[Check]:
    """Bind all rules of a dataset, in the given order.

    Rules that cannot run come back as errors: those that Spark refuses, and those whose literals or patterns don't fit the
    column. Rules written by users may raise on some row (a cast, a division by zero); they tell such rows by ``broken``, and
    whoever counts verdicts makes errors of them. No row is read here, of a table or of a stream.
    """
    moment = instant(as_of)
    bound = [compile_rule(df, rule, refs, moment) for rule in rules]
    rest = iter(_isolate([c for c in bound if c.kind == "row"], _analyse(df)))
    return [next(rest) if c.kind == "row" else c for c in bound]


def runnable(checks: Sequence[Check]) -> list[Check]:
    return [c for c in checks if c.kind != "error"]


def expectations(checks: Sequence[Check], enforcement: str | None = None) -> dict[str, Column]:
    """``{rule_id__rule_name: predicate}`` for all row rules; key rules need other rows and are left out."""
    return {
        f"{c.rule.rule_id}__{c.rule.rule_name}": c.predicate
        for c in checks
        if c.kind == "row" and (enforcement is None or c.rule.enforcement == enforcement)
    }
