"""The registered queries: the engine's operators on the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake import schemas
from assaylake.functions.columns import masked
from assaylake.model import Reference, Rule
from assaylake.operators import (
    enforce,
    feedback,
    gold,
    governance,
    lineage,
    profile,
    reports,
    rulebook,
    sketches,
    summary,
    trend,
    verdict,
)
from assaylake.plans import incremental
from assaylake.plans.compile import compile_rules, expectations
from assaylake.plans.engine import Dataset, Result, log_only, publish, run_rules
from assaylake.plans.metrics import Run, execution_log, rule_counts
from assaylake.plans.registry import run_registry
from assaylake.plans.verdicts import evaluate
from assaylake.plans.versions import RuleVersion, annotate_versions, version_counts
from assaylake.session import fresh_path, settle
from assaylake.sources import tables
from assaylake.sources.rules import read_rules, read_rules_table, registry_references
from assaylake.streaming import running, validate
from assaylake.workload import rulebase
from assaylake.workload.suites import SUITES, load

Query = Callable[[SparkSession, str], DataFrame]
Out = TypeVar("Out")
QUERIES: dict[str, Query] = {}

RUN_ID = "run-1"
REPORTED = tuple(SUITES)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _run(name: str) -> Run:
    return Run(RUN_ID, name, SUITES[name].as_of)


def _result(spark: SparkSession, sf: str, name: str, mode: str = "row") -> Result:
    d = SUITES[name].dataset(spark, sf)
    return run_rules(d.frame, d.rules, _run(name), d.refs, mode)


def _overlap(spark: SparkSession, work: Callable[[str], Out], names: Sequence[str]) -> list[Out]:
    """The work of several datasets, four at a time: their jobs for key rules and for rules by users overlap."""
    with ThreadPoolExecutor(4) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), names))


def _results(spark: SparkSession, sf: str, names: Sequence[str], mode: str = "row") -> dict[str, Result]:
    return dict(zip(names, _overlap(spark, lambda n: _result(spark, sf, n, mode), names)))


def _compact(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The validated table with failed results only, which splits, listings and failure details need no more of."""
    return verdict.validated(_result(spark, sf, name).verdicts, SUITES[name].as_of, "failed")


def _counts(spark: SparkSession, sf: str, name: str, pick: Callable[[Rule], bool] = lambda r: True) -> DataFrame:
    d = SUITES[name].dataset(spark, sf)
    rules = [r for r in d.rules if pick(r)]
    return rule_counts(d.frame, compile_rules(d.frame, rules, d.refs, SUITES[name].as_of))


def _log(spark: SparkSession, sf: str, names=REPORTED) -> DataFrame:
    def log(name: str) -> DataFrame:
        d = SUITES[name].dataset(spark, sf)
        return log_only(d.frame, d.rules, _run(name), d.refs)

    return verdict.union_all(_overlap(spark, log, names))


def _scores(spark: SparkSession, sf: str, names=REPORTED) -> DataFrame:
    return verdict.union_all([r.score for r in _results(spark, sf, names).values()])


def _both(spark: SparkSession, sf: str, names=REPORTED) -> tuple[DataFrame, DataFrame]:
    """Log and scores of the same runs; Spark computes the counters they share once."""
    results = list(_results(spark, sf, names).values())
    return verdict.union_all([r.log for r in results]), verdict.union_all([r.score for r in results])


def _summaries(spark: SparkSession, sf: str, names=REPORTED) -> tuple[DataFrame, DataFrame]:
    """Summaries by dataset and by rule of the same runs."""
    results = _results(spark, sf, names)
    by_dataset = [summary.dataset_summary(r.counts, n) for n, r in results.items()]
    by_rule = [summary.rule_summary(r.counts.rule_counts(), n) for n, r in results.items()]
    return verdict.union_all(by_dataset), verdict.union_all(by_rule)


def _by_rule(spark: SparkSession, sf: str, names=REPORTED) -> DataFrame:
    return verdict.union_all(_overlap(spark, lambda n: summary.rule_summary(_counts(spark, sf, n), n), names))


def _by_dataset(spark: SparkSession, sf: str, names=REPORTED) -> DataFrame:
    return verdict.union_all([summary.dataset_summary(r.counts, n) for n, r in _results(spark, sf, names).items()]).drop("evaluated_at")


# --- single rules -----------------------------------------------------------------------------------------

LOG_COLUMNS = ("rule_id", "rule_type", "status", "total_records", "passed_count", "failed_count", "dq_score")

# query name -> (suite, rule)
SINGLE = {
    "not_null_orders": ("orders", "DQR-200001"),
    "range_customer_acctbal": ("customer", "DQR-100001"),
    "range_onesided_lineitem": ("lineitem", "DQR-300002"),
    "regex_part_brand": ("part", "DQR-400001"),
    "regex_customer_name": ("customer", "DQR-100003"),
    "uniqueness_lineitem_key": ("lineitem", "DQR-300001"),
    "uniqueness_customer_balance": ("customer", "DQR-100004"),
    "uniqueness_document_text": ("documents", "DQR-600002"),
    "allowed_values_orderstatus": ("orders", "DQR-200003"),
    "length_document_text": ("documents", "DQR-600001"),
    "ref_integrity_orders_customer": ("orders", "DQR-200004"),
    "ref_integrity_lineitem_part": ("lineitem", "DQR-300006"),
    "freshness_orders": ("orders", "DQR-200005"),
    "freshness_events": ("events", "DQR-500003"),
    "custom_sql_lineitem": ("lineitem", "DQR-300005"),
    "custom_sql_document_address": ("documents", "DQR-600006"),
    "error_rule_customer": ("customer", "DQR-100008"),
}


def _single(suite: str, rule_id: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        counts = _counts(spark, sf, suite, lambda r: r.rule_id == rule_id)
        return execution_log(counts, _run(suite)).select(*LOG_COLUMNS)

    return run


for _name, (_suite, _rule) in SINGLE.items():
    QUERIES[_name] = _single(_suite, _rule)

# Uniqueness with and without NULL keys, and within a partition.
NULL_KEYS = {
    "uniqueness_null_ignored": {"columns": ["o_custkey", "o_orderpriority"]},
    "uniqueness_null_equal": {"columns": ["o_custkey", "o_orderpriority"], "nulls": "equal"},
    "uniqueness_within_status": {"scope": "partition", "partition_by": ["o_orderstatus"], "columns": ["o_custkey"]},
}


def _unique(params: dict) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = SUITES["orders"].frame(spark, sf)
        rule = Rule("DQR-210001", "uniqueness", "o_custkey", params, "error", "hard")
        v = evaluate(df, compile_rules(df, [rule]))
        return verdict.validated(v).select("o_orderkey", F.col("_dq.all_passed").alias("is_unique"))

    return run


for _name, _params in NULL_KEYS.items():
    QUERIES[_name] = _unique(_params)


@query
def ref_integrity_rows_lineitem(spark, sf):
    """Verdict of every line: two references on one table, joined back to the rows."""
    v = _result(spark, sf, "lineitem").verdicts
    return v.frame.select(
        "l_orderkey", "l_linenumber", "l_partkey", v.passed(3).alias("order_settled"), v.passed(5).alias("small_part")
    )


@query
def allowed_values_long_list(spark, sf):
    """A list of 20,000 values compares as a short one does."""
    df = load(spark, sf, "lineitem")
    rule = Rule("DQR-310001", "allowed_values", "l_partkey", {"values": list(range(0, 60_000, 3))})
    return execution_log(rule_counts(df, compile_rules(df, [rule])), _run("lineitem")).select(*LOG_COLUMNS)


@query
def expectation_counts(spark, sf):
    """All row rules of orders as named expectations, counted in one pass."""
    d = SUITES["orders"].dataset(spark, sf)
    found = expectations(compile_rules(d.frame, d.rules, d.refs, SUITES["orders"].as_of))
    counted = d.frame.agg(*[F.count_if(p).alias(f"p{i}") for i, p in enumerate(found.values())], F.count(F.lit(1)).alias("n"))
    rows = [
        F.struct(F.lit(name).alias("expectation"), F.col(f"p{i}").alias("passed_records"), (F.col("n") - F.col(f"p{i}")).alias("failed_records"))
        for i, name in enumerate(found)
    ]
    return counted.select(F.inline(F.array(*rows)))


# --- summaries, verdicts, splits --------------------------------------------------------------------------


def _rule_summary(suite: str) -> Query:
    return lambda spark, sf: summary.rule_summary(_counts(spark, sf, suite), suite)


for _suite in SUITES:
    QUERIES[f"rule_summary_{_suite}"] = _rule_summary(_suite)


@query
def dataset_summary(spark, sf):
    return _by_dataset(spark, sf, tuple(SUITES))


@query
def row_verdicts_customer(spark, sf):
    d = _result(spark, sf, "customer").validated
    return d.select(
        "c_custkey",
        F.concat_ws(",", "_dq.passed_rules").alias("passed_rules"),
        F.concat_ws(",", "_dq.failed_rules").alias("failed_rules"),
        F.col("_dq.passed_count").alias("passed_count"),
        F.col("_dq.failed_count").alias("failed_count"),
        F.col("_dq.total_rules").alias("total_rules"),
        F.col("_dq.row_score").alias("row_score"),
        F.col("_dq.all_passed").alias("all_passed"),
    )


@query
def row_flags_orders(spark, sf):
    flat = verdict.annotate(_result(spark, sf, "orders").verdicts, SUITES["orders"].as_of)
    flags = [verdict.flag_name(r.rule_id) for r in SUITES["orders"].rules()]
    return flat.select("o_orderkey", *flags, "_dq_failed_count", "_dq_row_score")


@query
def row_score_distribution(spark, sf):
    return verdict.union_all([reports.score_distribution(_compact(spark, sf, n), n) for n in REPORTED])


@query
def row_score_stats(spark, sf):
    return verdict.union_all([reports.score_stats(_compact(spark, sf, n), n) for n in REPORTED])


@query
def clean_orders(spark, sf):
    return _result(spark, sf, "orders").clean


@query
def quarantine_orders(spark, sf):
    d = enforce.quarantine(_compact(spark, sf, "orders"), SUITES["orders"].as_of)
    return d.select("o_orderkey", "o_custkey", "o_totalprice", "_quarantine_reason")


@query
def soft_flag_events(spark, sf):
    return enforce.flag_soft(_compact(spark, sf, "events"), "dq_flag").select("event_id", "dq_flag")


@query
def clean_vs_quarantine(spark, sf):
    return reports.clean_versus_quarantined(_scores(spark, sf))


def _order_entries(spark, sf, mode="row"):
    d = SUITES["orders"].dataset(spark, sf)
    # A narrow record: the payload is compared as text.
    frame = d.frame.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return run_rules(frame, d.rules, _run("orders"), d.refs, mode)


@query
def quarantine_entries(spark, sf):
    d = SUITES["orders"].dataset(spark, sf)
    frame = d.frame.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    rules = [r for r in d.rules if r.column in frame.columns and r.rule_id != "DQR-200008"]
    entries = run_rules(frame, rules, _run("orders"), d.refs).entries("o_orderkey")
    return entries.select(
        "quarantine_id", "rule_id", "rule_type", "source_table", "record_key", "record_payload", "quarantine_reason", "severity"
    )


@query
def quarantine_entries_sequential(spark, sf):
    entries = _order_entries(spark, sf, "sequential").entries("o_orderkey")
    return entries.select("rule_id", "record_key", "severity", "quarantine_reason")


@query
def quarantine_volume(spark, sf):
    parts = [r.entries(SUITES[n].primary_key) for n, r in _results(spark, sf, REPORTED).items()]
    return reports.quarantine_volume(verdict.union_all(parts))


@query
def quarantine_breakdown(spark, sf):
    parts = [r.entries(SUITES[n].primary_key) for n, r in _results(spark, sf, REPORTED).items()]
    return reports.quarantine_breakdown(verdict.union_all(parts))


@query
def quarantine_by_type(spark, sf):
    parts = [r.entries(SUITES[n].primary_key) for n, r in _results(spark, sf, REPORTED).items()]
    return reports.quarantine_breakdown(verdict.union_all(parts), with_reason=False)


@query
def quarantine_listing(spark, sf):
    held = enforce.quarantine(_compact(spark, sf, "part"))
    return reports.quarantine_listing(held, ["p_partkey", "p_name", "p_brand"]).drop("_quarantined_at")


def _sequential_log(suite: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _result(spark, sf, suite, "sequential").log.select("dataset_name", "enforcement_mode", *LOG_COLUMNS)

    return run


for _suite in ("customer", "orders", "lineitem", "documents"):
    QUERIES[f"sequential_log_{_suite}"] = _sequential_log(_suite)

SCORE_COLUMNS = (
    "dataset_name", "total_rules", "rules_passed", "rules_failed", "rules_errored", "overall_dq_score",
    "total_records_in", "total_records_out", "rule_pass_ratio", "pass_rate_pct", "quarantined_rows", "quarantine_entries",
)


@query
def dataset_scores(spark, sf):
    return _scores(spark, sf).select(*SCORE_COLUMNS, "avg_row_score")


@query
def sequential_scores(spark, sf):
    return verdict.union_all([r.score for r in _results(spark, sf, REPORTED, "sequential").values()]).select(*SCORE_COLUMNS)


@query
def processing_summary(spark, sf):
    return summary.processing_summary(verdict.union_all([r.score for r in _results(spark, sf, REPORTED, "sequential").values()]))


@query
def silver_customer(spark, sf):
    """Clean rows in sequential mode with audit columns."""
    r = _result(spark, sf, "customer", "sequential")
    return r.silver.drop("_dq_processed_at")


@query
def detail_all(spark, sf):
    parts = []
    for name in REPORTED:
        parts.append(verdict.detail(_result(spark, sf, name).validated, name, SUITES[name].primary_key))
    return verdict.union_all(parts).select(
        "dataset_name", "primary_key_value", "rule_id", "rule_type", "target_column", "severity", "enforcement", "passed", "row_score", "all_passed"
    )


@query
def detail_failures_lineitem(spark, sf):
    d = verdict.detail(_compact(spark, sf, "lineitem"), "lineitem", SUITES["lineitem"].primary_key, failures_only=True)
    return d.select("primary_key_value", "rule_id", "row_score")


@query
def detail_flat_part(spark, sf):
    """The detail from flat flag columns."""
    v = _result(spark, sf, "part").verdicts
    flat = verdict.annotate(v, SUITES["part"].as_of)
    return verdict.detail_flat(flat, list(v.rules), "part", "p_partkey").select("primary_key_value", "rule_id", "passed", "row_score")


@query
def published_orders(spark, sf):
    """The compact validated table, stored once, and the layer each row reached."""
    dataset = SUITES["orders"].dataset(spark, sf)
    result = _result(spark, sf, "orders")
    stored = publish(result, dataset, lambda frame, name: settle(frame, name), results="failed")
    key = F.col("o_orderkey")
    return stored["clean"].select(key, F.lit("clean").alias("layer")).unionByName(
        stored["quarantine"].select(key, F.lit("quarantine").alias("layer"))
    )


@query
def rerun_log(spark, sf):
    """Log rows per run after runs a, b and a again: a rerun replaces its own rows."""
    path = fresh_path(spark, "log")
    for run_id in ("a", "b", "a"):
        d = SUITES["part"].dataset(spark, sf)
        tables.write_run(log_only(d.frame, d.rules, Run(run_id, "part", SUITES["part"].as_of), d.refs), path)
    return tables.read_parquet(spark, path).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("rules"), F.countDistinct("execution_id").alias("ids"), F.sum("failed_count").alias("failures")
    )


@query
def csv_source_orders(spark, sf):
    """Orders through a CSV landing folder, read with an explicit schema, then checked."""
    path = fresh_path(spark, "landing")
    frame = SUITES["orders"].frame(spark, sf)
    frame.write.option("header", True).csv(path)
    landed = tables.read_csv(spark, path, frame.schema)
    rules = [r for r in SUITES["orders"].rules() if r.rule_type not in ("referential_integrity",)]
    return execution_log(rule_counts(landed, compile_rules(landed, rules, as_of=SUITES["orders"].as_of)), _run("orders")).select(*LOG_COLUMNS)


def _broken_lines(spark, sf):
    """Orders as CSV lines of which some do not fit: a price in words, a line of two fields."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")]
    words = F.concat_ws(",", *text[:3], F.lit("twelve"), text[4])
    few = F.concat_ws(",", *text[:2])
    line = F.when(F.col("o_orderkey") % 10 == 3, words).when(F.col("o_orderkey") % 10 == 7, few).otherwise(F.concat_ws(",", *text))
    path = fresh_path(spark, "broken-lines")
    load(spark, sf, "orders").select(line.alias("value")).write.text(path)
    return path


_LINE = (
    T.StructType()
    .add("o_orderkey", T.LongType())
    .add("o_custkey", T.LongType())
    .add("o_orderstatus", T.StringType())
    .add("o_totalprice", T.DoubleType())
    .add("o_orderpriority", T.StringType())
)


def _split_lines(landed):
    good = tables.fitting(landed).select(F.lit("bronze").alias("went"), "o_orderkey", "o_totalprice", F.lit(None).cast("string").alias("record"), F.lit(None).cast("string").alias("reason"))
    bad = tables.rescued(landed).where(F.col("source_file").contains("broken-lines"))
    none = F.lit(None)
    return good.unionByName(bad.select(F.lit("quarantine").alias("went"), none.cast("bigint").alias("o_orderkey"), none.cast("double").alias("o_totalprice"), "record", "reason"))


@query
def csv_rescued_orders(spark, sf):
    """A landing folder with broken records: the good rows, and the broken ones with the reason."""
    return _split_lines(tables.land(spark, _broken_lines(spark, sf), _LINE, fresh_path(spark, "landed"), header=False))


@query
def csv_rescued_stream(spark, sf):
    """The same files as a stream."""
    return _split_lines(_finished(spark, tables.landing_csv(spark, _broken_lines(spark, sf), _LINE, stream=True, header=False), "landed-stream"))


@query
def lineage_orders(spark, sf):
    at = SUITES["orders"].as_of
    bronze = lineage.bronze_stamp(load(spark, sf, "orders"), "bronze.orders", "parquet", "daily", "2001-08-02", at)
    full = lineage.gold_enrich(lineage.silver_enrich(bronze, "silver.orders", at), "gold.orders", at)
    return full.select(
        "o_orderkey",
        F.col("_lineage.source.file_name").alias("file_name"),
        F.col("_lineage.source.format").alias("format"),
        F.col("_lineage.source.file_date").alias("file_date"),
        F.col("_lineage.bronze.table").alias("bronze_table"),
        F.col("_lineage.silver.table").alias("silver_table"),
        F.col("_lineage.gold.table").alias("gold_table"),
        F.col("_lineage.gold.processed_at").cast("timestamp_ntz").alias("processed_at"),
        F.col("_lineage.pipeline.name").alias("pipeline"),
    )


# --- rule tables ------------------------------------------------------------------------------------------


@query
def rule_contract_audit(spark, sf):
    audited = rulebook.audit_rules(rulebase.raw_rules(spark, sf))
    return audited.select("rule_id", "rule_type", "version", F.concat_ws("; ", "errors").alias("reasons"), "is_valid")


def _valid(spark, sf):
    valid, _ = rulebook.split_rules(rulebase.raw_rules(spark, sf))
    return rulebook.normalise_rules(valid, at=rulebase.AS_OF)


@query
def rule_normalise(spark, sf):
    return _valid(spark, sf).select(
        "rule_id", "rule_name", "rule_type", "target_column", "severity", "is_active", "version", "effective_from", "effective_to", "source_system"
    )


@query
def rule_upsert(spark, sf):
    merged = rulebook.upsert(
        rulebase.stored_rules(spark, sf),
        rulebase.extracted_rules(spark, sf),
        ["rule_id", "version"],
        changed=~F.col("t.checksum").eqNullSafe(F.col("s.checksum")),
        action="action",
    )
    return merged


@query
def rule_upsert_by_id(spark, sf):
    merged = rulebook.upsert_rules_by_id(rulebase.stored_rules(spark, sf), rulebase.extracted_rules(spark, sf), "action")
    return merged.drop("checksum")


@query
def changed_rules(spark, sf):
    changed = rulebook.changed_rules(rulebase.stored_rules(spark, sf), rulebase.extracted_rules(spark, sf))
    return changed.select("rule_id", "version", "severity")


@query
def mapping_upsert(spark, sf):
    mappings = rulebook.normalise_mappings(rulebase.mappings(spark, sf))
    stored = mappings.where("priority < 3").withColumn("enforcement_mode", F.lit("soft"))
    return rulebook.upsert_mappings(stored, mappings.where("is_active"), "action").drop("column_name")


@query
def registry_upsert(spark, sf):
    now, before = F.lit("2000-01-01").cast("date"), F.lit("1999-01-01").cast("date")
    found = rulebase.datasets(spark, sf)
    stored = found.where("is_active").withColumns({"is_active": F.lit(False), "created_at": before, "updated_at": before})
    source = found.withColumns({"created_at": now, "updated_at": now})
    return rulebook.upsert_datasets(stored, source, "action").drop("ref_tables", "source_table", "primary_key")


@query
def registry_references_by_dataset(spark, sf):
    return registry_references(rulebase.datasets(spark, sf))


@query
def rule_resolution(spark, sf):
    resolved = rulebook.resolve_rules(_valid(spark, sf), rulebase.mappings(spark, sf), as_of=rulebase.AS_OF)
    return resolved.drop("params", "rule_name")


@query
def rule_resolution_no_dates(spark, sf):
    resolved = rulebook.resolve_rules(_valid(spark, sf), rulebase.mappings(spark, sf), "returns_R", check_dates=False)
    return resolved.drop("params", "rule_name")


@query
def effective_rules(spark, sf):
    return rulebook.effective(_valid(spark, sf), rulebase.AS_OF).select("rule_id", "version", "effective_from", "effective_to")


@query
def rule_census(spark, sf):
    return rulebook.rule_census(_valid(spark, sf))


@query
def mapping_census(spark, sf):
    return rulebook.mapping_census(rulebook.normalise_mappings(rulebase.mappings(spark, sf)))


@query
def rule_coverage(spark, sf):
    resolved = rulebook.resolve_by_registry(rulebase.datasets(spark, sf), rulebase.mappings_by_id(spark, sf), _valid(spark, sf))
    return rulebook.rule_coverage(resolved)


@query
def rule_history(spark, sf):
    return governance.rule_history(rulebase.rule_versions(spark, sf)).select(
        "rule_id", "version", "valid_from", "valid_to", "is_current"
    )


@query
def rule_conflicts(spark, sf):
    return governance.range_conflicts(rulebase.quantity_rules(spark, sf))


@query
def value_conflicts(spark, sf):
    return governance.value_conflicts(rulebase.status_rules(spark, sf))


@query
def schema_drift(spark, sf):
    raw = rulebase.raw_rules(spark, sf)
    gone = F.when(F.col("severity") == "info", "p_colour").otherwise("p_retailprice")
    resolved = raw.select(F.lit("part").alias("dataset_name"), "rule_id", gone.alias("target_column"))
    return governance.drifted_rules(resolved, governance.schema_columns({"part": load(spark, sf, "part")})).select("rule_id", "target_column")


# --- business tables --------------------------------------------------------------------------------------

CUSTOMER_VIEW = ("c_custkey", "c_name", "c_mktsegment")


def _customer_view(customers, orders, **kw):
    return gold.customer_360(
        customers, orders, key="c_custkey", transaction_key="o_custkey", amount="o_totalprice", date="o_orderdate", carry=CUSTOMER_VIEW, **kw
    ).drop("_gold_processed_at")


@query
def customer_360(spark, sf):
    return _customer_view(load(spark, sf, "customer"), load(spark, sf, "orders"))


@query
def customer_360_clean(spark, sf):
    customers = enforce.clean(_compact(spark, sf, "customer"))
    orders = _result(spark, sf, "orders").clean
    view = _customer_view(customers, orders, fill_zero=True)
    return view.withColumn("row_score", F.col("_dq.row_score")).drop("_dq")


@query
def engagement_distribution(spark, sf):
    return gold.engagement_distribution(customer_360(spark, sf))


@query
def part_catalog(spark, sf):
    clean = enforce.clean(_compact(spark, sf, "part"))
    catalog = gold.product_catalog(clean, columns=["p_partkey", "p_name", "p_brand", "p_type"], price="p_retailprice")
    return catalog.drop("_gold_processed_at", "_dq")


def _sales(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_partkey", "l_extendedprice", "l_quantity")
    parts = load(spark, sf, "part").select("p_partkey", "p_brand")
    return gold.sales_metrics_by(
        lines, parts, key="l_partkey", of="p_partkey", group="p_brand", amount="l_extendedprice", quantity="l_quantity"
    )


@query
def sales_by_brand(spark, sf):
    return _sales(spark, sf)


@query
def top_brands(spark, sf):
    return gold.top_sellers(_sales(spark, sf), "p_brand", 5)


@query
def executive_summary(spark, sf):
    return gold.executive_summary(_scores(spark, sf)).drop("scored_at", "_gold_processed_at")


# --- reports ----------------------------------------------------------------------------------------------


@query
def overall_score(spark, sf):
    return reports.overall_score(_scores(spark, sf))


@query
def overall_row_score(spark, sf):
    return reports.overall_score(_by_dataset(spark, sf), "pass_rate_pct")


@query
def scorecard(spark, sf):
    return reports.scorecard(_scores(spark, sf)).drop("scored_at")


@query
def pass_rate_by_type(spark, sf):
    return reports.by_rule_type(_log(spark, sf)).drop("avg_duration_ms")


@query
def top_failing_rules(spark, sf):
    return reports.top_failing_rules(_log(spark, sf))


@query
def heatmap(spark, sf):
    return reports.heatmap(_log(spark, sf))


@query
def severity_distribution(spark, sf):
    return reports.by_severity(_log(spark, sf))


@query
def rule_detail_report(spark, sf):
    return reports.rule_detail(_log(spark, sf)).drop("execution_duration_ms")


@query
def enforcement_effect(spark, sf):
    return reports.enforcement_effect(_log(spark, sf))


@query
def sla_violations(spark, sf):
    return reports.sla_violations(_log(spark, sf))


@query
def execution_listing(spark, sf):
    return reports.execution_listing(_log(spark, sf), RUN_ID)


@query
def framework_health(spark, sf):
    return reports.framework_health(*_both(spark, sf))


@query
def kpi_counters(spark, sf):
    return reports.kpi_counters(*_summaries(spark, sf))


@query
def pass_rate_by_dataset(spark, sf):
    return reports.pass_rate_by_dataset(_by_dataset(spark, sf))


@query
def rule_health(spark, sf):
    return reports.rule_health(_by_rule(spark, sf))


@query
def failures_by_type(spark, sf):
    return reports.failures_by_type(_by_rule(spark, sf), total_row=True)


@query
def rules_by_severity(spark, sf):
    return reports.rules_by_severity(_by_rule(spark, sf))


@query
def rule_failure_ranking(spark, sf):
    return reports.rule_failure_ranking(_by_rule(spark, sf))


@query
def worst_rows(spark, sf):
    return reports.worst_rows(_compact(spark, sf, "orders"), ["o_orderkey", "o_custkey"]).drop("_dq_evaluated_at")


@query
def failing_rows_part(spark, sf):
    return reports.worst_rows(_compact(spark, sf, "part"), ["p_partkey", "p_name"], k=None).drop("_dq_evaluated_at")


@query
def feedback_payload(spark, sf):
    return feedback.feedback_payload(*_both(spark, sf), RUN_ID).drop("payload")


@query
def feedback_digest(spark, sf):
    return feedback.feedback_digest(feedback.feedback_payload(*_both(spark, sf)))


# --- trends and alerts ------------------------------------------------------------------------------------


@query
def score_trend(spark, sf):
    """Daily pass rate of the event value rule per event type, with rolling means over 7 and 30 days."""
    events = load(spark, sf, "events")
    daily = trend.daily_counts(events, F.col("value").between(1, 100), F.col("ts"), ["event_type"])
    return trend.score_trend(daily, ["event_type"])


@query
def domain_score(spark, sf):
    domains = spark.createDataFrame(
        [("customer", "sales"), ("orders", "sales"), ("part", "supply"), ("events", "web")], "dataset_name string, domain string"
    )
    return trend.domain_score(_scores(spark, sf), domains).drop("day")


@query
def quarantine_rate(spark, sf):
    return trend.quarantine_rate(_scores(spark, sf)).drop("run_id")


@query
def alerts(spark, sf):
    log, scores = _both(spark, sf)
    return trend.alerts(scores, log)


@query
def circuit_breaker(spark, sf):
    return enforce.gate(_scores(spark, sf), 25.0).drop("run_id")


# --- care of quarantined records --------------------------------------------------------------------------


@query
def quarantine_reprocess(spark, sf):
    """Entries of the strict order rules, judged again by relaxed ones."""
    result = _order_entries(spark, sf)
    strict = result.entries("o_orderkey")
    relaxed = [
        Rule("DQR-200001", "not_null", "o_orderkey", {}),
        Rule("DQR-200002", "range", "o_totalprice", {"min": 2000, "max": 475000}),
        Rule("DQR-200003", "allowed_values", "o_orderstatus", {"values": ["F", "O"]}),
        Rule("DQR-200005", "freshness", "o_orderdate", {"max_age_hours": 40000}),
        Rule("DQR-200004", "referential_integrity", "o_custkey", {"ref_table": "customer", "ref_column": "c_custkey"}),
        Rule("DQR-200007", "regex", "o_orderpriority", {"pattern": "^[1-5]-"}),
        Rule("DQR-200008", "not_null", "o_custkey", {}),
    ]
    refs = {"customer": Reference(load(spark, sf, "customer").where("c_acctbal > -500"))}
    schema = result.verdicts.frame.select(*result.verdicts.source).schema
    done = governance.reprocess(strict, schema, relaxed, refs, SUITES["orders"].as_of)
    return done.select("rule_id", "record_key", F.coalesce("resolution_action", F.lit("open")).alias("resolution"))


@query
def quarantine_keys_lineitem(spark, sf):
    """Quarantine log of line items, whose records are named by two columns."""
    entries = _result(spark, sf, "lineitem").entries(SUITES["lineitem"].primary_key)
    return entries.select("record_key", "rule_id", "quarantine_reason")


@query
def quarantine_released(spark, sf):
    """Duplicate customers among odd orders, judged again by customer and priority, among the open entries and the even
    orders that they would return to."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    strict = Rule("DQR-230001", "uniqueness", "o_custkey", {}, "error", "hard")
    relaxed = Rule("DQR-230001", "uniqueness", "o_custkey", {"columns": ["o_custkey", "o_orderpriority"]})
    entries = run_rules(orders.where("o_orderkey % 2 = 1"), [strict], _run("orders")).entries(("o_orderkey", "o_custkey"))
    done = governance.reprocess(entries, orders.schema, [relaxed], as_of=SUITES["orders"].as_of, clean=orders.where("o_orderkey % 2 = 0"))
    return done.select("record_key", F.coalesce("resolution_action", F.lit("open")).alias("resolution"))


@query
def quarantine_retention(spark, sf):
    """Entries dated by their order, kept for three years."""
    result = _order_entries(spark, sf)
    schema = result.verdicts.frame.select("o_orderdate").schema
    entries = governance.restore(result.entries("o_orderkey"), schema, ("rule_id", "record_key"))
    dated = entries.withColumn("quarantined_at", F.col("o_orderdate").cast("timestamp"))
    kept, _ = governance.retain(dated, 3 * 365, SUITES["orders"].as_of)
    return kept.groupBy("rule_id").agg(F.count(F.lit(1)).alias("kept"))


@query
def pii_masking(spark, sf):
    """Names leave the quarantine log only as digests."""
    result = _result(spark, sf, "customer")
    entries = result.entries("c_custkey", mask={"c_name": "hash", "c_mktsegment": "redact"})
    return entries.select(
        "rule_id",
        "record_key",
        F.get_json_object("record_payload", "$.c_name").alias("c_name"),
        F.get_json_object("record_payload", "$.c_mktsegment").alias("c_mktsegment"),
    )


@query
def mask_forms(spark, sf):
    s = load(spark, sf, "supplier")
    mail = F.concat(F.lower("s_name"), F.lit("@example.com"))
    return s.select("s_suppkey", masked(mail, "email").alias("mail"), masked(F.col("s_name"), "hash").alias("name"))


# --- profiling and reconciliation -------------------------------------------------------------------------

PROFILED = ("o_custkey", "o_orderstatus", "o_orderpriority")


@query
def profile_orders(spark, sf):
    return profile.exact_distinct(profile.value_counts(SUITES["orders"].frame(spark, sf), PROFILED))


@query
def profile_statistics(spark, sf):
    frame = SUITES["orders"].frame(spark, sf).select("o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    return profile.profile(frame).drop("approx_distinct", "median", "type")


@query
def profile_approximate(spark, sf):
    """Whether the approximate figures of every column stay within their error bounds of the exact ones."""
    frame = SUITES["orders"].frame(spark, sf)
    found = profile.profile(frame)
    exact = profile.exact_distinct(profile.value_counts(frame, [r["column"] for r in found.select("column").collect()]))
    joined = found.join(exact.select("column", "distinct"), "column")
    off = F.abs(F.col("approx_distinct") - F.col("distinct"))
    medians = {r["column"]: r["median"] for r in found.where("median IS NOT NULL").collect()}  # a row per column
    ranks = frame.agg(
        *[(F.count_if(F.col(c) < m) / F.count(c)).alias(f"{c}<") for c, m in medians.items()],
        *[(F.count_if(F.col(c) <= m) / F.count(c)).alias(f"{c}=") for c, m in medians.items()],
    )
    lines = F.array(
        *[F.struct(F.lit(c).alias("column"), ((F.col(f"`{c}<`") <= 0.51) & (F.col(f"`{c}=`") >= 0.49)).alias("median_ok")) for c in medians]
    )
    return joined.join(ranks.select(F.inline(lines)), "column", "left").select(
        "column", (off <= F.col("distinct") * 0.1 + 1).alias("distinct_ok"), F.coalesce("median_ok", F.lit(True)).alias("median_ok")
    )


def _order_sketches(spark, sf):
    """Sketches of the orders of each year, stored, and those of four years read back."""
    orders = load(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    some = F.col("part").between(1996, 1999)
    parts = settle(sketches.sketch_parts(orders, "year", columns), "sketches").where(some)
    return orders.where("year BETWEEN 1996 AND 1999"), parts, settle(sketches.frequent_parts(orders, "year", columns), "frequent").where(some)


@query
def profile_merged(spark, sf):
    """Profile of four years from the sketches of each: exact figures, and whether approximate ones keep their bounds."""
    orders, parts, _ = _order_sketches(spark, sf)
    found = sketches.merged_profile(parts)
    exact = profile.exact_distinct(profile.value_counts(orders, [r["column"] for r in found.select("column").collect()]))
    medians = {r["column"]: r["median"] for r in found.where("quantiles IS NOT NULL").select("column", F.get("quantiles", F.lit(1)).alias("median")).collect()}
    off = sketches.RANK_ERROR
    ranks = orders.agg(*[
        F.struct(F.lit(c).alias("column"), ((F.count_if(F.col(c) < m) / F.count(c) <= 0.5 + off) & (F.count_if(F.col(c) <= m) / F.count(c) >= 0.5 - off)).alias("median_ok")).alias(c)
        for c, m in medians.items()
    ])
    ranks = ranks.select(F.inline(F.array(*medians)))
    joined = found.join(exact.select("column", "distinct"), "column").join(ranks, "column", "left")
    return joined.select(
        "column", "rows", "nulls", "min_value", "max_value", "min_length", "max_length",
        F.col("distinct").between(F.col("distinct_low"), F.col("distinct_high")).alias("distinct_ok"), F.coalesce("median_ok", F.lit(True)).alias("median_ok"),
    )


@query
def frequent_merged(spark, sf):
    """Values that are frequent in some of four years, with bounds that hold their exact counts."""
    orders, parts, frequent = _order_sketches(spark, sf)
    found = sketches.merged_frequent(frequent, parts).where("column IN ('o_orderstatus', 'o_orderpriority', 'o_custkey')")
    counts = profile.value_counts(orders, ["o_orderstatus", "o_orderpriority", "o_custkey"])
    joined = found.join(counts, ["column", "value"])
    return joined.select("column", "value", "at_least", F.col("n").between(F.col("at_least"), F.col("at_most")).alias("bounds_ok"))


@query
def top_values(spark, sf):
    return profile.top_values(profile.value_counts(load(spark, sf, "lineitem"), ["l_returnflag", "l_suppkey", "l_quantity"]), 5)


@query
def suggested_rules(spark, sf):
    frame = SUITES["orders"].frame(spark, sf).select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return profile.suggest_rules(profile.profile(frame), "orders")


@query
def reconcile_order_lines(spark, sf):
    return profile.reconcile(
        load(spark, sf, "orders"),
        load(spark, sf, "lineitem"),
        parent_key="o_orderkey",
        child_key="l_orderkey",
        parent_value=F.col("o_totalprice"),
        child_value=F.col("l_extendedprice"),
    )


# --- event time -------------------------------------------------------------------------------------------

WINDOW_RULES = [r for r in SUITES["events"].rules() if r.rule_id in ("DQR-500001", "DQR-500002", "DQR-500006")]


def _events(spark, sf):
    return load(spark, sf, "events").withColumn("at", F.col("ts").cast("timestamp"))


def _event_stream(spark, sf):
    schema = load(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return stream.withColumn("at", F.col("ts").cast("timestamp"))


def _plain_times(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def _finished(spark, stream, label):
    """Run a stream over the available input into the shared folder and read the result."""
    path = fresh_path(spark, label)
    validate.append_to(stream, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


@query
def event_window_metrics(spark, sf):
    return _plain_times(
        validate.window_metrics(_events(spark, sf), WINDOW_RULES, time="at", delay="1 hour", window=F.window("at", "6 hours"), by=["event_type"])
    )


@query
def event_sliding_metrics(spark, sf):
    return _plain_times(
        validate.window_metrics(_events(spark, sf), WINDOW_RULES, time="at", delay="1 hour", window=F.window("at", "2 days", "1 day"))
    )


@query
def event_sessions(spark, sf):
    return _plain_times(running.session_metrics(_events(spark, sf), WINDOW_RULES, time="at", gap="12 hours", by=["user_id"]))


def _followed(spark, stream, partial, label, late=False):
    """Run a stream over the available input and read the counters that its batches stored."""
    path = fresh_path(spark, label)
    running.follow(stream, partial, delay="1 hour", path=path, checkpoint=f"{path}/checkpoint").awaitTermination()
    return running.stored(spark, path, late)


def _window_totals(spark, sf, window, label, by=()):
    checks = running.row_checks(_events(spark, sf), WINDOW_RULES)
    parts = _followed(spark, _event_stream(spark, sf), running.window_partial(window, "at", by, running.window_counters(checks)), label)
    return _plain_times(running.per_rule(running.window_totals(parts, by), checks, by))


@query
def stream_window_metrics(spark, sf):
    """The same windows from a stream, the open ones included."""
    return _window_totals(spark, sf, F.window("at", "6 hours"), "window-metrics", ["event_type"])


@query
def stream_sliding_metrics(spark, sf):
    return _window_totals(spark, sf, F.window("at", "2 days", "1 day"), "sliding-metrics")


@query
def stream_sessions(spark, sf):
    """Sessions per user from a stream, the open ones included."""
    checks = running.row_checks(_events(spark, sf), WINDOW_RULES)
    partial = running.slot_partial("at", "12 hours", ["user_id"], running.window_counters(checks))
    slots = _followed(spark, _event_stream(spark, sf), partial, "session-metrics")
    return _plain_times(running.per_rule(running.sessions(slots, ["user_id"], "12 hours"), checks, ["user_id"]))


@query
def stream_closed_windows(spark, sf):
    """What a stream that appends gives: the windows that the watermark has closed."""
    metrics = validate.window_metrics(
        _event_stream(spark, sf), WINDOW_RULES, time="at", delay="1 hour", window=F.window("at", "6 hours"), by=["event_type"]
    )
    return _plain_times(_finished(spark, metrics, "closed-windows"))


def _in_parts(spark, sf, feed):
    """The events in three parts that arrive one after the other; ``feed`` is called after each arrival with the stream."""
    events = _events(spark, sf)
    folder = fresh_path(spark, "arrivals")
    for part in range(3):
        tables.write_overwrite(events.where(F.pmod("event_id", F.lit(3)) == part), f"{folder}/part={part}")
        feed(spark.readStream.schema(events.schema).parquet(folder))


def _late_parts(spark, sf, partial, late):
    path = fresh_path(spark, "late")
    _in_parts(spark, sf, lambda stream: running.follow(stream, partial, delay="1 hour", path=path, checkpoint=f"{path}/checkpoint").awaitTermination())
    return [running.stored(spark, path, which) for which in late]


@query
def stream_late_rows(spark, sf):
    """Rows of windows that were over when their part of the stream arrived, beside those in time."""
    in_time, late = _late_parts(spark, sf, running.window_partial(F.window("at", "6 hours"), "at", [], [F.count(F.lit(1)).alias("total")]), (False, True))
    late = running.window_totals(late, []).withColumnRenamed("total", "late")
    return _plain_times(running.window_totals(in_time, []).join(late, ["window_start", "window_end"], "full").fillna(0, ["total", "late"]))


@query
def stream_late_sessions(spark, sf):
    """Sessions of the rows in time, from a stream that arrives in three parts."""
    checks = running.row_checks(_events(spark, sf), WINDOW_RULES)
    (slots,) = _late_parts(spark, sf, running.slot_partial("at", "12 hours", ["user_id"], running.window_counters(checks)), (False,))
    return _plain_times(running.per_rule(running.sessions(slots, ["user_id"], "12 hours"), checks, ["user_id"]))


# The second cannot be evaluated on purchases, the third never fails.
TRIED = (
    Rule("DQR-510001", "range", "value", {"min": 1, "max": 100}, enforcement="hard"),
    Rule("DQR-510002", "custom_sql", "event_type", {"sql_expression": "CASE WHEN event_type = 'purchase' THEN CAST(event_type AS INT) > 0 ELSE value > 5 END"}),
    Rule("DQR-510003", "custom_sql", "event_type", {"sql_expression": "length(event_type) > 2"}),
)


@query
def stream_rule_errors(spark, sf):
    """A rule that cannot be evaluated on some rows of a stream: no verdict in the windows of these rows, and the others run."""
    checks = running.row_checks(_events(spark, sf), TRIED)
    parts = _followed(spark, _event_stream(spark, sf), running.window_partial(F.window("at", "6 hours"), "at", ["event_type"], running.window_counters(checks)), "rule-errors")
    return _plain_times(running.per_rule(running.window_totals(parts, ["event_type"]), checks, ["event_type"]))


@query
def stream_batch_log(spark, sf):
    """Log per micro-batch of a stream in three parts: references, and a rule that is an error of every batch."""
    path = fresh_path(spark, "batch-log")
    d = SUITES["events"].dataset(spark, sf)
    rules = [*[r for r in d.rules if r.rule_type != "uniqueness"], *TRIED]
    sinks = {"log": validate.batch_folder(path)}
    run = Run("stream", "events", SUITES["events"].as_of)
    _in_parts(spark, sf, lambda s: running.judge_batches(s.select(*d.frame.columns), rules, run, sinks, f"{path}-checkpoint", d.refs).awaitTermination())
    log = spark.read.parquet(path)
    return log.select("run_id", "rule_id", "status", "total_records", "passed_count", "error_message")


@query
def stream_validated_events(spark, sf):
    rules = [r for r in SUITES["events"].rules() if r.rule_type != "uniqueness"]
    refs = SUITES["events"].dataset(spark, sf).refs
    checked = validate.stream_validated(_event_stream(spark, sf).drop("at"), rules, SUITES["events"].as_of, refs)
    stored = _finished(spark, checked, "validated-events")
    return stored.select("event_id", F.concat_ws(",", "_dq.failed_rules").alias("failed_rules"), F.col("_dq.row_score").alias("row_score"))


@query
def stream_quarantine_events(spark, sf):
    """Two sinks per micro-batch, under all rules that a stream can judge."""
    d = SUITES["events"].dataset(spark, sf)
    rules = [r for r in d.rules if r.rule_type != "uniqueness"]
    path = fresh_path(spark, "routed-events")
    sinks = {name: validate.batch_folder(f"{path}/{name}") for name in ("clean", "quarantine")}
    run = Run("stream", "events", SUITES["events"].as_of)
    running.judge_batches(_event_stream(spark, sf).drop("at"), rules, run, sinks, f"{path}/checkpoint", d.refs, "failed").awaitTermination()
    columns = ["event_id", "event_type", "_quarantine_reason"]
    clean = spark.read.parquet(f"{path}/clean").withColumn("_quarantine_reason", F.lit(None).cast("string"))
    held = spark.read.parquet(f"{path}/quarantine")
    return verdict.union_all([df.select(F.lit(sink).alias("sink"), *columns) for sink, df in (("clean", clean), ("quarantine", held))])


@query
def stream_duplicates(spark, sf):
    """Keys that occur more than once in a day, the last days included."""
    keys = ["user_id", "event_type"]
    parts = _followed(spark, _event_stream(spark, sf), running.window_partial(F.window("at", "1 day"), "at", keys, [F.count(F.lit(1)).alias("total")]), "duplicates")
    return _plain_times(running.duplicates(parts, keys))


@query
def stream_first_seen(spark, sf):
    """Distinct keys that a stream lets through."""
    seen = validate.first_seen(_event_stream(spark, sf), ["user_id", "event_type"], time="at", delay="60 days")
    return _finished(spark, seen, "first-seen").select("user_id", "event_type")


# --- runs, errors and sinks ---------------------------------------------------------------------------------


@query
def incremental_lineitem(spark, sf):
    """Three batches of line items, each judged without the rows of the others: the summary of all."""
    suite, state = SUITES["lineitem"], fresh_path(spark, "incremental")
    d = suite.dataset(spark, sf)
    for batch in range(3):
        incremental.add_batch(d.frame.where(F.pmod("l_partkey", F.lit(3)) == batch), d.rules, state, batch, d.refs, suite.as_of)
    return summary.rule_summary(incremental.counts_so_far(spark, d.rules, state), "lineitem")


# Two rules of orders as they were over the years; the status rule ended in 2001, and has not been in force before 1995.
ORDER_VERSIONS = [
    RuleVersion(Rule("DQR-240001", "range", "o_totalprice", {"min": 1000}), 1),
    RuleVersion(Rule("DQR-240001", "range", "o_totalprice", {"min": 20000, "max": 300000}), 2, "1996-01-01", "1999-07-01"),
    RuleVersion(Rule("DQR-240001", "range", "o_totalprice", {"max": 400000}), 3, "1999-07-01"),
    RuleVersion(Rule("DQR-240002", "allowed_values", "o_orderstatus", {"values": ["F"]}), 1, "1995-01-01", "1997-01-01"),
    RuleVersion(Rule("DQR-240002", "allowed_values", "o_orderstatus", {"values": ["F", "O"]}), 2, "1998-01-01", "2001-01-01"),
]


@query
def rule_versions_orders(spark, sf):
    """Every order judged by the versions in force on its date."""
    rows = annotate_versions(load(spark, sf, "orders"), ORDER_VERSIONS, "o_orderdate")
    return rows.select("o_orderkey", F.inline("_dq_versions"))


@query
def rule_version_counts(spark, sf):
    counts = version_counts(load(spark, sf, "orders"), ORDER_VERSIONS, "o_orderdate")
    return counts.select("rule_id", "version", "total_records", "passed_count")


@query
def registry_run(spark, sf):
    """All suites through the registry loop: validated tables, logs and scores stored, durations measured."""
    datasets = [
        Dataset(n, n, s.primary_key, d.frame, tuple(d.rules), d.refs) for n, s in SUITES.items() for d in (s.dataset(spark, sf),)
    ]
    moments = {s.as_of for s in SUITES.values()}
    scores, logs = [], []
    for moment in sorted(moments):
        chosen = [d for d in datasets if SUITES[d.name].as_of == moment]
        run = run_registry(chosen, RUN_ID, settle, moment, results="failed")
        if run.problems:
            raise RuntimeError(str(run.problems))
        scores.append(run.scores)
        logs.append(run.log)
    timed = verdict.union_all(logs).groupBy("dataset_name").agg(F.every(F.col("execution_duration_ms") >= 0).alias("timed"))
    return verdict.union_all(scores).select(*SCORE_COLUMNS, "avg_row_score").join(timed, "dataset_name")


# Rules that fail while they run, next to good ones.
FAILING = (
    Rule("DQR-220001", "regex", "o_orderpriority", {"pattern": "[a-"}),
    Rule("DQR-220002", "allowed_values", "o_custkey", {"values": ["x", "1"]}),
    Rule("DQR-220003", "range", "o_custkey", {"min": "abc"}),
    Rule("DQR-220004", "custom_sql", "o_orderstatus", {"sql_expression": "CAST(o_orderstatus AS INT) > 0"}),
    Rule("DQR-220005", "custom_sql", "o_custkey", {"sql_expression": "1 / (o_custkey - o_custkey) > 0"}),
    Rule("DQR-220006", "range", "o_totalprice", {"min": 2000}),
    Rule("DQR-220007", "regex", "o_orderpriority", {"pattern": "^[1-5]-"}),
)


@query
def error_rules_orders(spark, sf):
    log = log_only(load(spark, sf, "orders"), FAILING, Run(RUN_ID, "orders", SUITES["orders"].as_of))
    return log.select("rule_id", "status", "total_records", "passed_count")


@query
def sink_modes(spark, sf):
    """Overwritten, appended, appended with a further column, truncated: rows by how they came into the table."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path, emptied = fresh_path(spark, "sink"), fresh_path(spark, "sink")
    kind = lambda name: orders.withColumn("came", F.lit(name))
    tables.write_overwrite(kind("replaced"), path)
    tables.write_overwrite(kind("overwritten").where("o_orderstatus = 'F'").drop("o_orderstatus"), path)
    tables.write_append(kind("appended").where("o_orderstatus = 'O'").drop("o_orderstatus"), path)
    tables.append_merging(kind("merged").where("o_orderstatus = 'P'"), path)
    tables.write_overwrite(orders, emptied)
    tables.truncate(spark, emptied, orders.schema)
    counted = tables.read_merging(spark, path).groupBy("came").agg(
        F.count(F.lit(1)).alias("n"), F.count("o_orderstatus").alias("with_status"), F.sum("o_custkey").alias("keys")
    )
    left = spark.read.schema(orders.schema).parquet(emptied).agg(F.lit("truncated").alias("came"), F.count(F.lit(1)).alias("n"))
    return tables.union_merging(counted, left)


@query
def rule_documents(spark, sf):
    """A rule per part, written as JSON documents and as a table, and read through the fallback: the table comes first. A
    document holds the rules whose numbers differ in the last four digits, and is a file of its own, since a file is read as one."""
    stored = rulebase.part_rules(spark, sf)
    whole = {f.name for f in schemas.RAW_RULE}
    entry = F.struct(*[c for c in ("rule_id", "severity") if c in whole])
    document, table = fresh_path(spark, "rules-json"), fresh_path(spark, "rules-table")
    documents = stored.groupBy(F.substring("rule_id", F.lit(1), F.length("rule_id") - 4).alias("part")).agg(F.collect_list(entry).alias("rules"))
    documents.select("rules").write.option("maxRecordsPerFile", 1).json(document)
    from_json = read_rules(spark, "no_such_rule_table", document)
    tables.write_overwrite(stored.withColumn("target_column", F.lit("p_size")).withColumn("params", F.lit("")), table)
    from_table = read_rules_table(spark, table)
    return from_json.select("rule_id", "severity", F.lit("json").alias("source"), F.lit(None).cast("string").alias("params")).unionByName(
        from_table.select("rule_id", "severity", F.lit("table").alias("source"), "params")
    )
