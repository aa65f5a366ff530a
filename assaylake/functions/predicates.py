"""Row rule types as native Column predicates: TRUE means the row passes, NULL counts as a failure."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.model import RuleError

Params = Mapping[str, Any]


@dataclass(frozen=True)
class Target:
    """The column under test, its type, the instant that freshness is measured against, and the column's name."""

    column: Column
    dtype: T.DataType
    as_of: Column
    name: str | None = None


Builder = Callable[[Params, Target], Column]
_BUILDERS: dict[str, Builder] = {}


def register_rule_type(name: str, build: Callable[..., Column], *, simple: bool = True) -> None:
    """Add a rule type.

    ``build(params, column)`` returns a boolean Column; with ``simple=False`` it gets the whole
    :class:`Target` instead of the column.
    """
    _BUILDERS[name] = (lambda params, target: build(params, target.column)) if simple else build


def row_rule_types() -> tuple[str, ...]:
    return tuple(_BUILDERS)


def build_predicate(rule_type: str, params: Params, target: Target) -> Column:
    if rule_type not in _BUILDERS:
        raise RuleError(f"unknown rule type '{rule_type}'")
    return _BUILDERS[rule_type](params, target)


def need(params: Params, name: str, rule_type: str) -> Any:
    value = params.get(name)
    if value is None:
        raise RuleError(f"{rule_type} rule requires '{name}'")
    return value


def listed(params: Params, name: str, rule_type: str) -> list:
    """A parameter that must be a list; a text would be taken as its letters."""
    value = need(params, name, rule_type)
    if isinstance(value, (str, bytes, Mapping)) or not isinstance(value, Iterable):
        raise RuleError(f"{rule_type} rule needs a list for '{name}'")
    return list(value)


def _bound(value: Any, dtype: T.DataType) -> Column:
    """A bound as a literal, typed by the column for dates and times."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(str(value)).cast(dtype)
    return F.lit(value)


def _comparable(target: Target, *bounds: Any) -> Column:
    """Text compared with numbers is read as a number; text that is none becomes NULL and fails."""
    numeric = any(isinstance(b, (int, float)) for b in bounds if b is not None)
    if numeric and isinstance(target.dtype, T.StringType):
        return target.column.try_cast("double")
    return target.column


def _between(value: Column, low: Column | None, high: Column | None, rule_type: str) -> Column:
    if low is None and high is None:
        raise RuleError(f"{rule_type} rule needs at least one bound")
    if low is None:
        return value <= high
    if high is None:
        return value >= low
    return (value >= low) & (value <= high)


def not_null(params: Params, target: Target) -> Column:
    return target.column.isNotNull()


def value_range(params: Params, target: Target) -> Column:
    low, high = params.get("min"), params.get("max")
    return _between(
        _comparable(target, low, high),
        None if low is None else _bound(low, target.dtype),
        None if high is None else _bound(high, target.dtype),
        "range",
    )


def regex(params: Params, target: Target) -> Column:
    pattern = need(params, "pattern", "regex")
    return target.column.cast("string").rlike(pattern)


def allowed_values(params: Params, target: Target) -> Column:
    values = listed(params, "values", "allowed_values")
    if not values:
        raise RuleError("allowed_values rule has an empty list")
    compared = _comparable(target, *values)
    if target.name is None or not all(type(v) in (int, float, str) and v == v for v in values):
        return compared.isin(values)
    # The same expression parsed from text: a list of any length is one call to the JVM instead of one per value.
    name = f"`{target.name.replace('`', '``')}`"
    read = name if compared is target.column else f"try_cast({name} AS DOUBLE)"
    return F.expr(f"{read} IN ({', '.join(map(_literal, values))})")


def _literal(value: float | str) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST('{value!r}' AS DOUBLE)" if isinstance(value, float) else str(value)


def text_length(params: Params, target: Target) -> Column:
    low, high = params.get("min_length"), params.get("max_length")
    return _between(
        F.length(target.column.cast("string")),
        None if low is None else F.lit(int(low)),
        None if high is None else F.lit(int(high)),
        "length",
    )


def freshness(params: Params, target: Target) -> Column:
    hours = float(need(params, "max_age_hours", "freshness"))
    age = F.make_dt_interval(secs=F.lit(hours * 3600.0).cast("decimal(18,6)"))
    if isinstance(target.dtype, T.StringType):
        return target.column.try_cast("timestamp") >= target.as_of - age
    return target.column.cast("timestamp") >= target.as_of - age


_QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`")
_UNSTABLE = re.compile(
    r"\b(rand|randn|random|uuid|shuffle|monotonically_increasing_id|spark_partition_id|input_file_name)\b",
    re.IGNORECASE,
)


def custom_sql(params: Params, target: Target) -> Column:
    """A boolean SQL expression over the row; unstable functions are refused here, subqueries when it is bound."""
    text = need(params, "sql_expression", "custom_sql")
    bare = _QUOTED.sub("''", text)
    found = _UNSTABLE.search(bare)
    if found:
        raise RuleError(f"custom_sql must not use '{found.group(0)}'")
    return F.expr(f"({text})").cast("boolean")


for _name, _build in (
    ("not_null", not_null),
    ("range", value_range),
    ("regex", regex),
    ("allowed_values", allowed_values),
    ("length", text_length),
    ("freshness", freshness),
    ("custom_sql", custom_sql),
):
    register_rule_type(_name, _build, simple=False)
