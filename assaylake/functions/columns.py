"""Small Column helpers shared by operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: str | dt.datetime | None) -> Column:
    """A timestamp literal read in the session time zone; the current time if none is given."""
    if value is None:
        return F.current_timestamp()
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(value, dt.datetime) else value
    return F.lit(text).cast("timestamp")


def _balanced(op: Callable[[Column, Column], Column], columns: list[Column], empty: Column) -> Column:
    """Combine pairwise, so that hundreds of rules make a shallow expression."""
    if not columns:
        return empty
    while len(columns) > 1:
        pairs = [op(a, b) for a, b in zip(columns[::2], columns[1::2])]
        columns = pairs + columns[len(pairs) * 2 :]
    return columns[0]


def all_of(columns: list[Column]) -> Column:
    return _balanced(lambda a, b: a & b, columns, F.lit(True))


def any_of(columns: list[Column]) -> Column:
    return _balanced(lambda a, b: a | b, columns, F.lit(False))


def total_of(columns: list[Column]) -> Column:
    return _balanced(lambda a, b: a + b, columns, F.lit(0))


def _sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def constant(rows: list, dtype: str) -> Column:
    """A constant array of values or of structs given as dicts, in one expression that Spark folds to a literal.

    A Column per field would make plans of hundreds of rules slow to build.
    """
    items = []
    for row in rows:
        if isinstance(row, dict):
            items.append("named_struct(" + ", ".join(f"'{k}', {_sql_literal(v)}" for k, v in row.items()) + ")")
        else:
            items.append(_sql_literal(row))
    return F.expr(f"array({', '.join(items)})").cast(f"array<{dtype}>")


def picked(values: Column, flags: Column, wanted: bool = True) -> Column:
    """The values whose flag is ``wanted``, in order. ``flags`` should be a plain column: it is read per value.

    One lambda over two arrays instead of a branch per rule: with many rules the branches would make a generated
    method too long for the JVM to compile.
    """
    return F.filter(values, lambda _, i: F.get(flags, i) if wanted else ~F.get(flags, i))


def percent(part: Column, whole: Column, empty: float = 100.0, digits: int | None = 2) -> Column:
    """``part`` of ``whole`` in percent; ``empty`` where there is nothing to count.

    Multiplied before it is divided: a single rounding step keeps ties exact.
    """
    value = F.when(whole == 0, F.lit(empty)).otherwise(part * 100 / whole)
    return F.round(value, digits) if digits is not None else value


def mean_of(total: Column, count: Column, digits: int | None = 2) -> Column:
    """A decimal total over a count, divided as decimals so that ties round exactly; NULL for no rows."""
    value = total / F.when(count != 0, count)
    return (F.round(value, digits) if digits is not None else value).cast("double")


def exact_mean(column: str | Column, digits: int | None = 2) -> Column:
    """Mean of amounts or scores with two decimals; NULLs left out, independent of the order of partitions."""
    c = F.col(column) if isinstance(column, str) else column
    return mean_of(F.sum(c.cast("decimal(18,2)")), F.count(c), digits)


def stable_id(*parts: Column | str) -> Column:
    """An id that a rerun reproduces."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.sha2(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in cols]), 256)


#: What identifies a record: a column, or several.
Key = str | Sequence[str]


def record_key(key: Key) -> Column:
    """The key of a record as text: one column as it is, several as JSON with their names, NULLs included."""
    if isinstance(key, str):
        return F.col(f"`{key}`").cast("string")
    return F.to_json(F.struct(*[F.col(f"`{k}`") for k in key]), {"ignoreNullFields": "false"})


def health(score: Column, names: tuple[str, str, str]) -> Column:
    """Three-step traffic light: at least 95, at least 80, below."""
    return F.when(score >= 95, names[0]).when(score >= 80, names[1]).otherwise(names[2])


def masked(column: Column, how: str) -> Column:
    """Hide a personal value: ``hash`` keeps equality, ``redact`` keeps nothing, ``email`` keeps the domain,
    ``mask`` keeps the shape."""
    text = column.cast("string")
    if how == "hash":
        return F.sha2(text, 256)
    if how == "redact":
        return F.when(text.isNotNull(), F.lit("***"))
    if how == "email":
        return F.regexp_replace(text, r"^[^@]+", "***")
    if how == "mask":
        return F.mask(text)
    raise ValueError(f"unknown masking '{how}'")
