"""Metadata-driven data quality on Spark DataFrames."""

from assaylake.functions.predicates import register_rule_type
from assaylake.model import Check, Reference, Rule, RuleError, rules_from
from assaylake.plans.compile import compile_rule, compile_rules, expectations, rule_types
from assaylake.plans.engine import Dataset, Result, log_only, process, process_all, publish, run_rules
from assaylake.plans.metrics import Run
from assaylake.plans.registry import datasets_from_registry, run_registry
from assaylake.plans.verdicts import evaluate
from assaylake.session import build_session, settle, shared_dir

__all__ = [
    "Check",
    "Dataset",
    "Reference",
    "Result",
    "Rule",
    "RuleError",
    "Run",
    "build_session",
    "compile_rule",
    "compile_rules",
    "datasets_from_registry",
    "evaluate",
    "expectations",
    "log_only",
    "process",
    "process_all",
    "publish",
    "register_rule_type",
    "rule_types",
    "run_registry",
    "rules_from",
    "run_rules",
    "settle",
    "shared_dir",
]
