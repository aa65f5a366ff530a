"""From registry tables to runs: which datasets, which rules, which references, and what to store."""

from __future__ import annotations

import datetime as dt
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import groupby

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.model import Reference, rules_from
from assaylake.operators import rulebook
from assaylake.operators.verdict import union_all
from assaylake.plans.engine import Dataset, Result, Writer, process_and_publish
from assaylake.session import settle
from assaylake.sources.rules import registry_references

# Datasets whose jobs overlap.
PARALLEL_DATASETS = 4

Reader = Callable[[str], DataFrame]


def iter_datasets(
    datasets: DataFrame,
    mappings: DataFrame,
    rules: DataFrame,
    read: Reader,
    as_of: str | dt.datetime | None = None,
    check_dates: bool = True,
) -> Iterator[Dataset]:
    """The active datasets with their rules and references, one after the other; ``read`` opens a table by name.

    A reference rule on a column takes the table the registry names for ``<column>_ref``, else the table its
    params name. References that cannot be opened are left out: their rules become error rows, not failed runs. A dataset
    whose own table cannot be opened comes with ``problem`` instead of a frame. The driver holds one dataset's rules at a
    time, so neither rules nor datasets have a total bound.
    """
    resolved = rulebook.resolve_by_registry(datasets, mappings, rules, as_of, check_dates)
    active = datasets.where("is_active")
    named = registry_references(active).groupBy("dataset_id").agg(F.collect_list(F.struct("ref_name", "ref_table", "ref_column")).alias("__refs"))
    head = active.select("dataset_id", "dataset_name", "primary_key", "source_table").join(named, "dataset_id", "left")
    mapped_rules = resolved.select(F.col("dataset_name").alias("__of"), F.struct(*resolved.columns).alias("__rule"))
    rows = settle(head.join(mapped_rules, F.col("dataset_name") == F.col("__of"), "left"), "registry")
    ordered = rows.orderBy("dataset_id")
    for _, group in groupby(ordered.toLocalIterator(), key=lambda r: r["dataset_id"]):
        entries = list(group)
        row = entries[0]
        mapped = tuple(rules_from([e["__rule"].asDict() for e in entries if e["__rule"] is not None]))
        known = {r["ref_name"]: (r["ref_table"], r["ref_column"]) for r in row["__refs"] or ()}
        refs = {}
        for rule in mapped:
            if rule.rule_type == "referential_integrity":
                table, column = known.get(f"{rule.column}_ref", (rule.params.get("ref_table"), rule.params.get("ref_column")))
                frame = _open(read, table)
                if frame is not None:
                    refs[rule.rule_id] = Reference(frame, column)
        frame = _open(read, row["source_table"])
        problem = "" if frame is not None else f"table '{row['source_table']}' cannot be opened"
        yield Dataset(row["dataset_id"], row["dataset_name"], _key(row["primary_key"]), frame, mapped, refs, problem)


def datasets_from_registry(*registry, **options) -> list[Dataset]:
    """:func:`iter_datasets` as a list."""
    return list(iter_datasets(*registry, **options))


def _key(text: str) -> str | tuple[str, ...]:
    """The primary key that a registry names: a column, or several with commas between them."""
    names = tuple(k.strip() for k in text.split(","))
    return names if len(names) > 1 else names[0]


def _open(read: Reader, table: str | None) -> DataFrame | None:
    try:
        return read(table) if table else None
    except (AnalysisException, KeyError):
        return None


@dataclass(frozen=True)
class RegistryRun:
    """Results per dataset, the tables stored for each, stored log and scores of all, and why a dataset did not run."""

    results: dict[str, Result]
    tables: dict[str, dict[str, DataFrame]]
    log: DataFrame | None
    scores: DataFrame | None
    problems: dict[str, str]


def _run_one(d: Dataset, run_id: str, write: Writer, as_of, mode: str, results: str, threshold_pct: float | None):
    """One dataset: result with its measured duration, stored log and score, and its tables unless the gate is shut."""
    if d.frame is None:
        raise ValueError(d.problem)
    result, tables = process_and_publish(d, run_id, write, as_of, mode, results, threshold_pct)
    return result, tables, settle(result.log, f"{d.name}-log"), settle(result.score, f"{d.name}-score")


def run_registry(
    datasets: Iterable[Dataset],
    run_id: str,
    write: Writer,
    as_of: str | dt.datetime | None = None,
    mode: str = "row",
    results: str = "all",
    threshold_pct: float | None = None,
) -> RegistryRun:
    """Process every dataset, store its validated table, and derive clean, quarantine and detail from it.

    PARALLEL_DATASETS run at a time, and the next dataset is taken from ``datasets`` when one of them is done, so the driver
    holds the rules of these only. One that fails, or whose table cannot be opened, is noted in ``problems`` and the
    others go on. With ``threshold_pct`` a dataset too many of whose rows fail a hard rule is scored but not stored.
    """
    done: dict[str, Result] = {}
    tables: dict[str, dict[str, DataFrame]] = {}
    problems: dict[str, str] = {}
    logs, scores = [], []

    def work(d: Dataset):
        try:
            return _run_one(d, run_id, write, as_of, mode, results, threshold_pct)
        except (PySparkException, ValueError) as problem:
            return str(problem).split("\n")[0]

    def take(d: Dataset, out) -> None:
        if isinstance(out, str):
            problems[d.name] = out
            return
        done[d.name], stored, log, score = out
        if stored:
            tables[d.name] = stored
        logs.append(log)
        scores.append(score)

    with ThreadPoolExecutor(PARALLEL_DATASETS) as pool:
        running: deque = deque()
        for d in datasets:
            if len(running) == PARALLEL_DATASETS:
                first, job = running.popleft()
                take(first, job.result())
            session = d.frame.sparkSession if d.frame is not None else None
            running.append((d, pool.submit(inheritable_thread_target(session)(work) if session else work, d)))
        for d, job in running:
            take(d, job.result())
    return RegistryRun(done, tables, union_all(logs) if logs else None, union_all(scores) if scores else None, problems)
