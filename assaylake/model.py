"""Rules as the engine sees them on the driver."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class RuleError(ValueError):
    """A rule that cannot be turned into a predicate; becomes an ``error`` row of the log."""


@dataclass(frozen=True)
class Rule:
    """One rule mapped to one dataset."""

    rule_id: str
    rule_type: str
    column: str
    params: Mapping[str, Any] = field(default_factory=dict)
    severity: str = "warning"
    enforcement: str = "soft"
    rule_name: str = ""
    priority: int = 999

    @property
    def hard(self) -> bool:
        return self.enforcement == "hard"


@dataclass(frozen=True)
class Check:
    """A rule bound to a DataFrame.

    ``kind`` is ``row`` (``predicate`` decides from the row alone), ``unique`` or ``reference`` (the verdict
    belongs to a key and needs a look at other rows), or ``error``. ``broken`` tells the rows on which a rule written by a user
    cannot be evaluated; ``predicate`` is false there.
    """

    rule: Rule
    kind: str
    predicate: Column | None = None
    keys: tuple[str, ...] = ()
    null_equal: bool = False
    digest: bool = False
    reference: DataFrame | None = None
    message: str | None = None
    broken: Column | None = None

    def key_columns(self) -> list[Column]:
        """The key as columns; long texts may be compared by their SHA-256 digest."""
        columns = [F.col(f"`{k}`") for k in self.keys]
        return [F.sha2(c.cast("string"), 256) for c in columns] if self.digest else columns


@dataclass(frozen=True)
class Reference:
    """A table that a referential-integrity rule may name."""

    frame: DataFrame
    column: str | None = None


def rule_from_row(row: Mapping[str, Any]) -> Rule:
    """Build a rule from a resolved row or a JSON entry; ``column`` and ``target_column`` are synonyms."""
    params = row.get("params") or {}
    if isinstance(params, str):
        params = json.loads(params)
    priority = row.get("priority")
    return Rule(
        rule_id=row["rule_id"],
        rule_type=row["rule_type"],
        column=row.get("column") or row.get("target_column") or "",
        params=params,
        severity=row.get("severity") or "warning",
        enforcement=row.get("enforcement") or row.get("enforcement_mode") or "soft",
        rule_name=row.get("rule_name") or "",
        priority=999 if priority is None else int(priority),
    )


def rules_from(rows: Iterable[Mapping[str, Any]]) -> list[Rule]:
    """Rules in priority order, ties by rule id."""
    return sorted((rule_from_row(r) for r in rows), key=lambda r: (r.priority, r.rule_id))
