"""Schemas of the metadata and result tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Rule types, severities, enforcement modes and the rule-id pattern of the rule contract.
RULE_TYPES = (
    "not_null",
    "range",
    "regex",
    "uniqueness",
    "referential_integrity",
    "allowed_values",
    "length",
    "freshness",
    "custom_sql",
)
SEVERITIES = ("error", "warning", "info")
ENFORCEMENT_MODES = ("hard", "soft")
RULE_ID_PATTERN = r"^DQR-[0-9]{6,}$"
MAX_RULE_NAME = 255

# Parameters each rule type must carry.
REQUIRED_PARAMS = {
    "range": ("min", "max"),
    "regex": ("pattern",),
    "allowed_values": ("values",),
    "length": ("min_length", "max_length"),
    "referential_integrity": ("ref_table", "ref_column"),
    "freshness": ("max_age_hours",),
    "custom_sql": ("sql_expression",),
}


def _struct(text: str, required: tuple[str, ...] = ()) -> T.StructType:
    fields = []
    for item in text.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, _KINDS[kind], name not in required))
    return T.StructType(fields)


_KINDS: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}

# Rules as they arrive from the governance catalogue; params stay raw JSON text.
RAW_RULE = _struct(
    "rule_id string, rule_name string, rule_type string, column string, params string, severity string, "
    "is_active boolean, version int, effective_from string, effective_to string, description string, owner string"
)

RULES = _struct(
    "rule_id string, rule_name string, rule_type string, target_column string, params string, severity string, "
    "is_active boolean, version int, effective_from date, effective_to date, source_system string, "
    "created_at timestamp, updated_at timestamp, checksum string",
    required=("rule_id", "rule_type", "target_column", "severity"),
)

MAPPINGS = _struct(
    "mapping_id string, dataset_name string, column_name string, rule_id string, enforcement_mode string, "
    "priority int, is_active boolean",
    required=("mapping_id", "dataset_name", "column_name", "rule_id"),
)

MAPPINGS_BY_ID = _struct(
    "mapping_id string, dataset_id string, column_name string, rule_id string, enforcement_mode string, "
    "priority int, is_active boolean",
    required=("mapping_id", "dataset_id", "rule_id"),
)

DATASETS = _struct(
    "dataset_id string, dataset_name string, source_table string, primary_key string, bronze_dlt_table string, "
    "ref_tables string, is_active boolean, description string, created_at timestamp, updated_at timestamp",
    required=("dataset_id", "dataset_name", "source_table", "primary_key"),
)

EXECUTION_LOG = _struct(
    "execution_id string, run_id string, rule_id string, rule_type string, dataset_name string, "
    "target_column string, severity string, enforcement_mode string, status string, total_records bigint, "
    "passed_count bigint, failed_count bigint, dq_score double, error_message string, "
    "execution_duration_ms bigint, executed_at timestamp, executed_by string"
)

QUARANTINE = _struct(
    "quarantine_id string, execution_id string, run_id string, rule_id string, rule_type string, "
    "source_table string, record_key string, record_payload string, quarantine_reason string, severity string, "
    "quarantined_at timestamp, resolved_at timestamp, resolution_action string"
)

SCORES = _struct(
    "score_id string, run_id string, dataset_name string, total_rules int, rules_passed int, rules_failed int, "
    "rules_errored int, overall_dq_score double, total_records_in bigint, total_records_out bigint, "
    "records_quarantined bigint, scored_at timestamp, rule_pass_ratio double, mean_rule_score double, "
    "pass_rate_pct double, avg_row_score double, quarantined_rows bigint, quarantine_entries bigint"
)

RULE_RESULT = (
    "struct<rule_id:string,rule_name:string,rule_type:string,column:string,severity:string,"
    "enforcement:string,passed:boolean>"
)
VERDICT = (
    f"struct<results:array<{RULE_RESULT}>,passed_rules:array<string>,failed_rules:array<string>,"
    "passed_count:int,failed_count:int,total_rules:int,row_score:double,all_passed:boolean,evaluated_at:timestamp>"
)
LINEAGE = (
    "struct<source:struct<file_name:string,file_path:string,file_date:string,format:string>,"
    "bronze:struct<table:string,ingested_at:timestamp>,silver:struct<table:string,validated_at:timestamp>,"
    "gold:struct<table:string,processed_at:timestamp>,pipeline:struct<name:string,updated_at:timestamp>>"
)
