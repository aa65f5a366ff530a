"""Running a dataset: one function for the library user, one loop over the dataset registry."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from assaylake.functions.columns import Key
from assaylake.model import Check, Rule
from assaylake.operators import enforce, lineage, verdict
from assaylake.plans.compile import References, compile_rules, in_error
from assaylake.plans.metrics import Run, Tally, counters, dataset_score, execution_log, rule_counts, tally
from assaylake.plans.verdicts import Verdicts, evaluate
from assaylake.session import settle

MODES = ("row", "sequential")


@dataclass(frozen=True)
class Result:
    """Everything a run yields; the frames share one verdict frame. Building it has already looked for the keys that key rules
    reject, and for rules by users that cannot be evaluated on some row, which must be known before rows are judged. The
    counters are taken by one pass and stored when log, score or summaries are first asked for."""

    run: Run
    checks: tuple[Check, ...]
    verdicts: Verdicts
    taken: Tally | None = None

    @cached_property
    def counts(self) -> Tally:
        return self.taken or tally(self.verdicts).stored()

    @property
    def validated(self) -> DataFrame:
        return verdict.validated(self.verdicts, self.run.as_of)

    @property
    def clean(self) -> DataFrame:
        return enforce.split(self.verdicts)[0]

    @property
    def quarantine(self) -> DataFrame:
        return enforce.split(self.verdicts)[1]

    @property
    def log(self) -> DataFrame:
        return execution_log(self.counts.rule_counts(), self.run)

    @property
    def score(self) -> DataFrame:
        return dataset_score(self.counts, self.run)

    @property
    def silver(self) -> DataFrame:
        """Clean rows with audit columns, the run's own score among them."""
        return enforce.silver(self.verdicts, self.run, float(self.score.first()["overall_dq_score"]))

    def lasting(self, duration_ms: int) -> Result:
        """The same with a measured duration, which the log then shows."""
        return replace(self, run=replace(self.run, duration_ms=duration_ms))

    def entries(self, record: Key, mask: Mapping[str, str] | None = None) -> DataFrame:
        return enforce.quarantine_log(self.verdicts, self.run, record, mask)


def run_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    run: Run,
    refs: References | None = None,
    mode: str = "row",
) -> Result:
    """Evaluate ``rules`` on ``df``.

    ``row``: every rule sees every row. ``sequential``: rules run in the given order and rows that fail a hard
    rule are hidden from the rules after it.
    """
    return _judge(df, _compiled(df, rules, run, refs, mode), run, mode)


def _compiled(df: DataFrame, rules: Sequence[Rule], run: Run, refs: References | None, mode: str) -> list[Check]:
    if mode not in MODES:
        raise ValueError(f"unknown mode '{mode}'")
    return compile_rules(df, rules, refs, run.as_of)


def _judge(df: DataFrame, checks: Sequence[Check], run: Run, mode: str) -> Result:
    """Rules by users are tried on all rows first, by a pass that reads their columns alone and shuffles nothing."""
    start = time.monotonic()
    able = in_error(checks, _unable(df, checks))
    result = Result(run, tuple(able), evaluate(df, able, sequential=mode == "sequential"))
    return replace(result, run=_timed(run, start)) if result.verdicts.broken() else result


def _unable(df: DataFrame, checks: Sequence[Check]) -> dict[str, int]:
    """Ids of the rules that cannot be evaluated on some rows, and on how many."""
    doubted = [c for c in checks if c.kind == "row" and c.broken is not None]
    if not doubted:
        return {}
    row = df.agg(*[F.count_if(c.broken).alias(f"e{i}") for i, c in enumerate(doubted)]).first()
    return {c.rule.rule_id: row[f"e{i}"] for i, c in enumerate(doubted) if row[f"e{i}"]}


def _timed(run: Run, start: float) -> Run:
    """The run with the time that it took, unless the caller gave one."""
    return run if run.duration_ms is not None else replace(run, duration_ms=round(1000 * (time.monotonic() - start)))


def log_only(df: DataFrame, rules: Sequence[Rule], run: Run, refs: References | None = None) -> DataFrame:
    """The execution log alone: row mode, no row is joined to key verdicts."""
    return execution_log(rule_counts(df, compile_rules(df, rules, refs, run.as_of)), run)


@dataclass(frozen=True)
class Dataset:
    """An entry of the dataset registry, resolved; without a frame if its table cannot be opened, for the given reason."""

    dataset_id: str
    name: str
    primary_key: Key
    frame: DataFrame | None
    rules: tuple[Rule, ...]
    refs: References
    problem: str = ""


def process(dataset: Dataset, run_id: str, as_of: str | dt.datetime | None = None, mode: str = "row") -> Result:
    return run_rules(dataset.frame, dataset.rules, Run(run_id, dataset.name, as_of), dataset.refs, mode)


def process_all(
    datasets: Iterable[Dataset], run_id: str, as_of: str | dt.datetime | None = None, mode: str = "row"
) -> dict[str, Result]:
    """The registry loop: plans are built on the driver, one per dataset; key rules count their keys, and rules by users take
    one pass over the rows."""
    return {d.name: process(d, run_id, as_of, mode) for d in datasets}


Writer = Callable[[DataFrame, str], DataFrame]


def publish(result: Result, dataset: Dataset, write: Writer, results: str = "all") -> dict[str, DataFrame]:
    """Write the validated table once and derive clean, quarantine and detail from the stored copy.

    ``write(frame, name)`` stores a frame, replacing one of that name, and returns a reader of it. With ``results="failed"``
    the table is compact and the detail lists failures only.
    """
    return _published(_store(result, result.verdicts, dataset, write, results), result, dataset)


def _store(result: Result, verdicts: Verdicts, dataset: Dataset, write: Writer, results: str) -> DataFrame:
    annotated = verdict.validated(verdicts, result.run.as_of, results)
    enriched = lineage.silver_enrich(annotated, f"silver.{dataset.name}_validated", result.run.as_of)
    return write(enriched, f"{dataset.name}_validated")


def _published(stored: DataFrame, result: Result, dataset: Dataset) -> dict[str, DataFrame]:
    return {
        "validated": stored,
        "clean": enforce.clean(stored),
        "quarantine": enforce.quarantine(stored, result.run.as_of),
        "detail": verdict.detail(stored, dataset.name, dataset.primary_key),
    }


def process_and_publish(
    dataset: Dataset,
    run_id: str,
    write: Writer,
    as_of: str | dt.datetime | None = None,
    mode: str = "row",
    results: str = "all",
    threshold_pct: float | None = None,
) -> tuple[Result, dict[str, DataFrame]]:
    """Run a dataset and publish it in one pass over its rows; key rules count their keys before, by their columns alone.

    The counters behind log and score are observed while the validated table is written. If a rule by a user turns out not
    to be evaluable on some row, the table is written again without it. With ``threshold_pct`` rows are stored in the
    shared folder first, and handed to ``write`` only if the gate is open; else there are no tables.
    """
    run = Run(run_id, dataset.name, as_of)
    checks = _compiled(dataset.frame, dataset.rules, run, dataset.refs, mode)
    first = write if threshold_pct is None else settle
    while True:
        start = time.monotonic()
        verdicts = evaluate(dataset.frame, checks, sequential=mode == "sequential")
        result = Result(run, tuple(checks), verdicts)
        seen = Observation()
        watched = replace(verdicts, frame=verdicts.frame.observe(seen, *counters(verdicts)))
        stored = _store(result, watched, dataset, first, results)
        counts = _observed(seen, verdicts)
        unable = counts.broken()
        if not unable:
            break
        checks = in_error(checks, unable)
    result = replace(result, run=_timed(run, start), taken=counts)
    if threshold_pct is not None:
        if not enforce.gate(result.score, threshold_pct).first()["publish"]:
            return result, {}
        stored = write(stored, f"{dataset.name}_validated")
    return result, _published(stored, result, dataset)


def _observed(seen: Observation, verdicts: Verdicts) -> Tally:
    """Counters from a finished write. Spark may drop the observer of a frame that it knows to be empty."""
    plain = tally(verdicts)
    names = plain.frame.columns
    row = seen.get
    if not all(n in row for n in names):
        return plain.stored()
    return Tally(verdicts.frame.sparkSession.createDataFrame([tuple(row[n] for n in names)], plain.frame.schema), verdicts)
