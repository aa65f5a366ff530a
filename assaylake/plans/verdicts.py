"""The verdict frame: the input plus one boolean per rule, from which everything else is derived."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import all_of, total_of
from assaylake.model import Check, Rule
from assaylake.plans.compile import runnable
from assaylake.plans.keyed import BadKeys, attach_key_verdict, bad_keys, find_bad_keys, join_shuffled, set_aside

# Verdicts that share a number while rows are shuffled.
PACKED = 30


@dataclass(frozen=True)
class Verdicts:
    """``frame`` holds the ``source`` columns and one verdict column per rule.

    In sequential mode ``__first_fail`` holds the position of the first hard rule a row fails; a rule sees only
    rows that no earlier hard rule removed.
    """

    frame: DataFrame
    source: tuple[str, ...]
    rules: tuple[Rule, ...]
    checks: tuple[Check, ...]
    sequential: bool = False

    def passed(self, position: int) -> Column:
        return F.col(_name(position))

    def broken(self) -> dict[int, Column]:
        """By position, the rows on which a rule written by a user cannot be evaluated."""
        able = runnable(self.checks)
        return {i: F.col(f"__e{i}") for i, c in enumerate(able) if c.broken is not None}

    def flags(self, failed: bool = False) -> Column:
        """All verdicts as one array: passed, or failed among the rows a rule sees."""
        rules = range(len(self.rules))
        columns = [self.failed(i) if failed else self.passed(i) for i in rules]
        return F.array(*columns) if columns else F.array().cast("array<boolean>")

    def seen(self, position: int) -> Column | None:
        """Rows the rule is applied to; None for all rows."""
        if not self.sequential:
            return None
        return F.col("__first_fail").isNull() | (F.col("__first_fail") >= position)

    def failed(self, position: int) -> Column:
        seen = self.seen(position)
        return ~self.passed(position) if seen is None else seen & ~self.passed(position)

    @property
    def hard(self) -> list[int]:
        return [i for i, rule in enumerate(self.rules) if rule.hard]

    def clean(self) -> Column:
        """No hard rule failed."""
        if self.sequential:
            return F.col("__first_fail").isNull()
        return all_of([self.passed(i) for i in self.hard])

    def passed_count(self) -> Column:
        return total_of([self.passed(i).cast("int") for i in range(len(self.rules))])

    def row_score(self) -> Column:
        """Percent of rules the row passes; 100 if there are none."""
        if not self.rules:
            return F.lit(100.0)
        return F.round(self.passed_count() * 100 / len(self.rules), 2)


def _name(position: int) -> str:
    return f"__v{position}"


def row_verdicts(checks: Sequence[Check]) -> list[Column]:
    """Verdict columns of the row rules, and of those by users the rows that they cannot judge."""
    rules = [(i, c) for i, c in enumerate(checks) if c.kind == "row"]
    broken = [c.broken.alias(f"__e{i}") for i, c in rules if c.broken is not None]
    return [*[c.predicate.alias(_name(i)) for i, c in rules], *broken]


def evaluate(df: DataFrame, checks: Sequence[Check], sequential: bool = False) -> Verdicts:
    """Attach the verdicts of all runnable rules."""
    able = runnable(checks)
    frame = _sequential(df, able) if sequential else _independent(df, able)
    return Verdicts(frame, tuple(df.columns), tuple(c.rule for c in able), tuple(checks), sequential)


def _attach(df: DataFrame, checks: list[Check], found: dict[int, BadKeys]) -> DataFrame:
    """Verdicts of key rules by position, and of all row rules in one projection.

    Broadcast key rules are joined first. If others need a shuffle, the verdicts known before it go through it as bits of a
    number, so that no column has to that only rules look at.
    """
    near, far = ({i: f for i, f in found.items() if f.broadcast is few} for few in (True, False))
    frame = df
    for i, keys in near.items():
        frame = attach_key_verdict(frame, keys, _name(i))
    judged = row_verdicts(checks)
    if not far:
        return frame.select("*", *judged)
    broken = [f"__e{i}" for i, c in enumerate(checks) if c.kind == "row" and c.broken is not None]
    settled = [_name(i) for i, c in enumerate(checks) if c.kind == "row" or i in near]
    bits = {**_bits("__b", settled), **_bits("__c", broken)}
    source = [F.col(f"`{c}`") for c in df.columns]
    packed = [total_of([F.when(F.col(n), F.lit(1 << k)).otherwise(F.lit(0)) for k, n in enumerate(names)]).alias(b) for b, names in bits.items()]
    frame = frame.select("*", *judged).select(*source, *packed)
    for i, keys in far.items():
        frame = set_aside(frame, keys, _name(i))
    for i, keys in far.items():
        frame = join_shuffled(frame, keys, _name(i))
    unpacked = [(F.col(b).bitwiseAND(F.lit(1 << k)) != 0).alias(n) for b, names in bits.items() for k, n in enumerate(names)]
    return frame.select(*source, *[F.col(_name(i)) for i in far], *unpacked)


def _bits(prefix: str, names: list[str]) -> dict[str, list[str]]:
    return {f"{prefix}{at}": names[at : at + PACKED] for at in range(0, len(names), PACKED)}


def _independent(df: DataFrame, checks: list[Check]) -> DataFrame:
    keyed = [i for i, c in enumerate(checks) if c.kind in ("unique", "reference")]
    return _attach(df, checks, dict(zip(keyed, find_bad_keys(df, [checks[i] for i in keyed]))))


def _sequential(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Only uniqueness depends on the survivors of earlier hard rules; its keys are looked for in rule order, among rows joined
    to no other keys than those of the earlier hard rules."""
    keyed = [i for i, c in enumerate(checks) if c.kind == "reference"]
    found = dict(zip(keyed, find_bad_keys(df, [checks[i] for i in keyed])))
    for i, check in enumerate(checks):
        if check.kind == "unique":
            earlier = {k: c for k, c in enumerate(checks[:i]) if c.rule.hard}
            rows = df
            for k, c in earlier.items():
                if c.kind != "row":
                    rows = attach_key_verdict(rows, found[k], _name(k))
            survives = [c.predicate if c.kind == "row" else F.col(_name(k)) for k, c in earlier.items()]
            found[i] = bad_keys(rows, check, all_of(survives) if survives else None)
    frame = _attach(df, checks, found)
    stops = [F.when(~F.col(_name(i)), F.lit(i)) for i, c in enumerate(checks) if c.rule.hard]
    nothing = F.lit(None).cast("int")
    return frame.withColumn("__first_fail", F.least(*stops, nothing, nothing) if stops else nothing)
