"""Operators on tables of rules, mappings and datasets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake import schemas
from assaylake.functions.columns import instant
from assaylake.model import Rule, rules_from

# A rule list is read by the driver to build one plan; far longer lists belong into several datasets.
MAX_RULES_PER_DATASET = 10_000


def _has_param(name: str) -> Column:
    return F.get_json_object("params", f"$.{name}").isNotNull()


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.length(F.col(name)) == 0)


def contract_errors() -> Column:
    """All violations of the rule contract as an array of reasons, empty for a valid rule."""
    reasons = [F.when(_blank(c), f"missing {c}") for c in ("rule_id", "rule_type", "column", "severity")]
    reasons += [
        F.when(~_blank("rule_id") & ~F.col("rule_id").rlike(schemas.RULE_ID_PATTERN), "bad rule_id"),
        F.when(~_blank("rule_type") & ~F.col("rule_type").isin(*schemas.RULE_TYPES), "unknown rule_type"),
        F.when(~_blank("severity") & ~F.col("severity").isin(*schemas.SEVERITIES), "unknown severity"),
        F.when(F.length("rule_name") > schemas.MAX_RULE_NAME, "rule_name too long"),
        F.when(F.col("version") < 1, "bad version"),
        F.when(F.col("effective_from").isNotNull() & F.col("effective_from").try_cast("date").isNull(), "bad effective_from"),
        F.when(
            (F.coalesce(F.col("effective_to"), F.lit("")) != "") & F.col("effective_to").try_cast("date").isNull(),
            "bad effective_to",
        ),
    ]
    for kind, names in schemas.REQUIRED_PARAMS.items():
        reasons += [F.when((F.col("rule_type") == kind) & ~_has_param(n), f"missing params.{n}") for n in names]
    return F.array_compact(F.array(*reasons))


def audit_rules(raw: DataFrame) -> DataFrame:
    """Raw rules with ``errors`` and ``is_valid``."""
    return raw.withColumn("errors", contract_errors()).withColumn("is_valid", F.size("errors") == 0)


def split_rules(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid with reasons)."""
    audited = audit_rules(raw)
    return audited.where("is_valid").drop("errors", "is_valid"), audited.where(~F.col("is_valid"))


def canonical_params(column: str = "params") -> Column:
    """Params with their keys in order, so that equal rules get equal checksums."""
    entries = F.map_entries(F.from_json(F.coalesce(F.col(column), F.lit("{}")), "map<string,string>"))
    return F.to_json(F.map_from_entries(F.array_sort(entries)))


def rule_checksum(df: DataFrame) -> Column:
    """SHA-256 over the rule as JSON with sorted keys."""
    skip = {"created_at", "updated_at", "checksum", "source_system", "errors", "is_valid"}
    names = sorted(c for c in df.columns if c not in skip)
    fields = [(canonical_params() if c == "params" else F.col(f"`{c}`")).alias(c) for c in names]
    return F.sha2(F.to_json(F.struct(*fields)), 256)


def _open_date(name: str) -> Column:
    """An empty or malformed date means no limit."""
    return F.col(name).try_cast("date")


def normalise_rules(raw: DataFrame, source_system: str = "catalogue", at: str | dt.datetime | None = None) -> DataFrame:
    """Raw rules in the canonical schema, with defaults and checksum."""
    now = instant(at)
    return raw.select(
        "rule_id",
        F.coalesce("rule_name", F.lit("")).alias("rule_name"),
        "rule_type",
        F.col("column").alias("target_column"),
        F.coalesce("params", F.lit("{}")).alias("params"),
        "severity",
        F.coalesce("is_active", F.lit(True)).alias("is_active"),
        F.coalesce("version", F.lit(1)).alias("version"),
        _open_date("effective_from").alias("effective_from"),
        _open_date("effective_to").alias("effective_to"),
        F.lit(source_system).alias("source_system"),
        now.alias("created_at"),
        now.alias("updated_at"),
        rule_checksum(raw).alias("checksum"),
    )


def normalise_mappings(raw: DataFrame) -> DataFrame:
    return raw.select(
        "mapping_id",
        "dataset_name",
        "column_name",
        "rule_id",
        F.coalesce("enforcement_mode", F.lit("soft")).alias("enforcement_mode"),
        F.coalesce("priority", F.lit(99)).alias("priority"),
        F.coalesce("is_active", F.lit(True)).alias("is_active"),
    )


def latest(source: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key, the one with the greatest ``order``; combines on the map side, unlike a window."""
    row = F.struct(*[F.col(f"`{c}`") for c in source.columns])
    picked = source.groupBy(*keys).agg(F.max_by(row, F.col(order)).alias("row"))
    return picked.select("row.*")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    keep: Sequence[str] = ("created_at",),
    changed: Column | None = None,
    action: str | None = None,
) -> DataFrame:
    """The target after merging ``source``; keys must be unique on both sides (see :func:`latest`).

    Matched rows take the source's values except for ``keep``; ``changed`` (over columns ``t.*`` and ``s.*``)
    limits the update to rows it accepts. ``action`` names an extra column telling what happened to the row.
    """
    columns = target.columns
    given = set(source.columns)

    def pack(df: DataFrame, alias: str) -> DataFrame:
        fields = [F.col(f"`{c}`") for c in columns if c in df.columns]
        return df.select(*[F.col(f"`{k}`").alias(f"__{k}") for k in keys], F.struct(*fields).alias(alias))

    names = [f"__{k}" for k in keys]
    both = pack(target, "t").join(pack(source, "s"), names, "full_outer")
    matched = F.col("t").isNotNull() & F.col("s").isNotNull()
    update = matched if changed is None else matched & F.coalesce(changed, F.lit(False))
    insert = F.col("t").isNull()

    def value(name: str) -> Column:
        old = F.col(f"t.`{name}`")
        if name not in given:
            return old
        new = F.col(f"s.`{name}`")
        if name in keep or name in keys:
            return F.when(insert, new).otherwise(old)
        return F.when(insert | update, new).otherwise(old)

    out = [value(c).alias(c) for c in columns]
    if action:
        out.append(
            F.when(insert, "inserted").when(update, "updated").when(matched, "unchanged").otherwise("kept").alias(action)
        )
    return both.select(*out)


def upsert_rules(target: DataFrame, source: DataFrame, action: str | None = None) -> DataFrame:
    """Match rule id and version; update only where the checksum differs."""
    return upsert(
        target,
        source,
        ["rule_id", "version"],
        keep=("created_at", "source_system"),
        changed=~F.col("t.checksum").eqNullSafe(F.col("s.checksum")),
        action=action,
    )


def upsert_rules_by_id(target: DataFrame, source: DataFrame, action: str | None = None) -> DataFrame:
    """Match the rule id alone and always update."""
    return upsert(target, source, ["rule_id"], action=action)


def upsert_mappings(target: DataFrame, source: DataFrame, action: str | None = None) -> DataFrame:
    return upsert(target, source, ["mapping_id"], keep=(), action=action)


def upsert_datasets(target: DataFrame, source: DataFrame, action: str | None = None) -> DataFrame:
    return upsert(target, source, ["dataset_id"], action=action)


def changed_rules(stored: DataFrame, extracted: DataFrame) -> DataFrame:
    """Incremental sync: the extracted rules that are new or differ from the stored ones."""
    known = stored.select("rule_id", "checksum").distinct()
    return extracted.join(known, ["rule_id", "checksum"], "left_anti")


def effective(rules: DataFrame, as_of: str | dt.datetime | None = None) -> DataFrame:
    """Rules in force on the day of ``as_of``, both ends included; a missing date means no limit."""
    day = instant(as_of).cast("date")
    start, end = _open_date("effective_from"), _open_date("effective_to")
    return rules.where((start.isNull() | (start <= day)) & (end.isNull() | (end >= day)))


def resolve_rules(
    rules: DataFrame,
    mappings: DataFrame,
    dataset: str | None = None,
    as_of: str | dt.datetime | None = None,
    check_dates: bool = True,
) -> DataFrame:
    """Active rules mapped to a dataset (or to all), with mode and priority."""
    mapped = mappings.where(F.coalesce("is_active", F.lit(True)))
    if dataset is not None:
        mapped = mapped.where(F.col("dataset_name") == dataset)
    mapped = mapped.select(
        "dataset_name",
        "rule_id",
        F.coalesce("enforcement_mode", F.lit("soft")).alias("enforcement_mode"),
        F.coalesce("priority", F.lit(999)).alias("priority"),
    )
    active = rules.where(F.coalesce("is_active", F.lit(True)))
    if check_dates:
        active = effective(active, as_of)
    joined = active.join(mapped, "rule_id")
    return joined.select(
        "dataset_name",
        "rule_id",
        "rule_name",
        "rule_type",
        "target_column",
        "params",
        "severity",
        "enforcement_mode",
        "priority",
    )


def resolve_by_registry(
    datasets: DataFrame, mappings: DataFrame, rules: DataFrame, as_of: str | dt.datetime | None = None, check_dates: bool = False
) -> DataFrame:
    """The same through the dataset registry: active datasets, mappings by dataset id, active rules."""
    named = datasets.where("is_active").select("dataset_id", "dataset_name")
    by_name = mappings.join(named, "dataset_id").drop("dataset_id")
    return resolve_rules(rules, by_name, as_of=as_of, check_dates=check_dates)


def to_rules(resolved: DataFrame) -> list[Rule]:
    """Bring the rules of one dataset to the driver, where its plan is built.

    This is control data. The bound is checked, not cut off: a longer list is an error.
    """
    rows = resolved.limit(MAX_RULES_PER_DATASET + 1).collect()
    if len(rows) > MAX_RULES_PER_DATASET:
        raise ValueError(f"more than {MAX_RULES_PER_DATASET} rules for one dataset")
    return rules_from(r.asDict() for r in rows)


def rule_census(rules: DataFrame) -> DataFrame:
    """Active rules per type and severity."""
    return rules.where("is_active").groupBy("rule_type", "severity").agg(F.count(F.lit(1)).alias("rule_count"))


def mapping_census(mappings: DataFrame) -> DataFrame:
    """Active mappings per dataset and enforcement mode."""
    active = mappings.where("is_active")
    return active.groupBy("dataset_name", "enforcement_mode").agg(F.count(F.lit(1)).alias("mapping_count"))


# The columns of the coverage table and the rule types each of them counts.
COVERAGE = {
    "not_null": ("not_null",),
    "range_rules": ("range",),
    "regex_rules": ("regex",),
    "length_rules": ("length",),
    "custom_sql": ("custom_sql",),
    "allowed_vals": ("allowed_values",),
    "other": ("uniqueness", "referential_integrity", "freshness"),
}


def rule_coverage(resolved: DataFrame) -> DataFrame:
    """Per dataset: distinct rules, and mappings per rule type."""
    n = F.count(F.lit(1))
    kinds = {c: F.count_if(F.col("rule_type").isin(*types)).alias(c) for c, types in COVERAGE.items()}
    # One row per rule first, so that the plain count over it is the distinct count.
    per_rule = resolved.groupBy("dataset_name", "rule_id").agg(*kinds.values())
    return per_rule.groupBy("dataset_name").agg(n.alias("total_rules"), *[F.sum(c).alias(c) for c in COVERAGE])


def generate_rules(spark, columns: Mapping[str, Mapping[str, Sequence[str]]], per_dataset: int) -> DataFrame:
    """A rule set for stress tests: templates and columns taken in turn.

    ``columns[dataset]`` holds the ``string`` and ``numeric`` columns of a dataset.
    """
    parts = []
    for number, (dataset, kinds) in enumerate(columns.items()):
        able = [t for t in TEMPLATES if kinds.get(t[1])]
        templates = F.array(
            *[
                F.struct(
                    F.lit(kind).alias("rule_type"),
                    F.array(*[F.lit(c) for c in kinds[target]]).alias("targets"),
                    F.lit(params).alias("params"),
                    F.lit(severity).alias("severity"),
                    F.lit(mode).alias("enforcement_mode"),
                )
                for kind, target, params, severity, mode in able
            ]
        )
        ids = spark.range(per_dataset).withColumn("t", F.get(templates, (F.col("id") % len(able)).cast("int")))
        named = ids.withColumn("column", F.get("t.targets", (F.col("id") % F.size("t.targets")).cast("int")))
        ordinal = F.col("id") + 101 + number * per_dataset
        parts.append(
            named.select(
                F.concat(F.lit("DQR-"), F.lpad(ordinal.cast("string"), F.greatest(F.lit(6), F.length(ordinal.cast("string"))), F.lit("0"))).alias("rule_id"),
                F.concat_ws("_", F.lit(dataset), "column", "t.rule_type", F.col("id").cast("string")).alias("rule_name"),
                F.col("t.rule_type").alias("rule_type"),
                F.col("column").alias("target_column"),
                F.replace(F.col("t.params"), F.lit("{col}"), F.col("column")).alias("params"),
                F.col("t.severity").alias("severity"),
                F.lit(dataset).alias("dataset_name"),
                F.col("t.enforcement_mode").alias("enforcement_mode"),
                (F.col("id") + 1).cast("int").alias("priority"),
                F.lit(True).alias("is_active"),
                F.lit(1).alias("version"),
                F.lit("2026-01-01").cast("date").alias("effective_from"),
                F.lit(None).cast("date").alias("effective_to"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Rule templates of the stress rule set (type, kind of column, params, severity, mode).
TEMPLATES = (
    ("not_null", "string", "{}", "error", "hard"),
    ("not_null", "numeric", "{}", "error", "hard"),
    ("range", "numeric", '{"min": 0, "max": 999999}', "error", "hard"),
    ("range", "numeric", '{"min": -100, "max": 100000}', "warning", "soft"),
    ("range", "numeric", '{"min": 1, "max": 50000}', "warning", "soft"),
    ("length", "string", '{"min_length": 1, "max_length": 200}', "warning", "soft"),
    ("length", "string", '{"min_length": 2, "max_length": 500}', "warning", "soft"),
    ("length", "string", '{"min_length": 1, "max_length": 100}', "info", "soft"),
    ("regex", "string", '{"pattern": "^.{1,}$"}', "warning", "soft"),
    ("regex", "string", '{"pattern": "^[^\\\\s].*[^\\\\s]$"}', "warning", "soft"),
    ("custom_sql", "numeric", '{"sql_expression": "{col} >= 0"}', "warning", "soft"),
    ("custom_sql", "numeric", '{"sql_expression": "{col} IS NOT NULL AND {col} < 10000000"}', "warning", "soft"),
    ("custom_sql", "numeric", '{"sql_expression": "CAST({col} AS DOUBLE) = {col}"}', "info", "soft"),
    (
        "allowed_values",
        "string",
        '{"values": ["valid", "invalid", "pending", "active", "inactive", "unknown", "new", "old"]}',
        "warning",
        "soft",
    ),
)
