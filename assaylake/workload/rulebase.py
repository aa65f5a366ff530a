"""Rule tables derived from the benchmark tables, so that rule operators are exercised at the tables' size.

Every part proposes a rule, every (part, return flag) of the line items maps one, every supplier is a dataset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.workload.suites import load

AS_OF = "2000-06-01 00:00:00"


def rule_id(key: str) -> Column:
    text = F.col(key).cast("string")
    return F.concat(F.lit("DQR-"), F.lpad(text, F.greatest(F.lit(6), F.length(text)), F.lit("0")))


def _by_number(number: Column, choices: dict[int, Column], otherwise: Column) -> Column:
    out = otherwise
    for n, value in choices.items():
        out = F.when(number == n, value).otherwise(out)
    return out


KINDS = (
    "not_null", "range", "regex", "uniqueness", "referential_integrity", "allowed_values", "length", "freshness",
    "custom_sql", "median_check",
)


def raw_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw rule per part, with some of every defect the rule contract knows."""
    part = load(spark, sf_dir, "part")
    size, key = F.col("p_size"), F.col("p_partkey")
    number = (size * 10).cast("string")
    full = {
        1: F.concat(F.lit('{"min":0,"max":'), number, F.lit("}")),
        2: F.lit('{"pattern":"^[a-z ]+$"}'),
        4: F.lit('{"ref_table":"nation","ref_column":"n_nationkey"}'),
        5: F.lit('{"values":["red ring","blue bolt"]}'),
        6: F.concat(F.lit('{"min_length":1,"max_length":'), number, F.lit("}")),
        7: F.lit('{"max_age_hours":24}'),
        8: F.lit('{"sql_expression":"p_size > 0"}'),
    }
    params = F.when(key % 7 == 0, F.lit('{"min":0}')).otherwise(_by_number(size % 10, full, F.lit("{}")))
    return part.select(
        F.when(key % 11 == 0, F.concat(F.lit("DQX-"), key.cast("string"))).otherwise(rule_id("p_partkey")).alias("rule_id"),
        F.col("p_name").alias("rule_name"),
        F.get(F.array(*[F.lit(k) for k in KINDS]), size % 10).alias("rule_type"),
        F.when(key % 17 == 0, F.lit("")).otherwise(F.lit("p_retailprice")).alias("column"),
        params.alias("params"),
        _by_number(size % 4, {0: F.lit("error"), 1: F.lit("warning"), 2: F.lit("info")}, F.lit("critical")).alias("severity"),
        (size % 5 != 0).alias("is_active"),
        (key % 3).cast("int").alias("version"),
        F.lit("1996-01-01").alias("effective_from"),
        _by_number(size % 6, {0: F.lit(""), 1: F.lit("1999-12-31"), 2: F.lit("2005-06-30")}, F.lit(None).cast("string")).alias("effective_to"),
    )


RAW_SQL = """
SELECT CASE WHEN p_partkey % 11 = 0 THEN 'DQX-' || CAST(p_partkey AS VARCHAR)
            ELSE 'DQR-' || lpad(CAST(p_partkey AS VARCHAR), greatest(6, length(CAST(p_partkey AS VARCHAR)))::INT, '0') END AS rule_id,
       p_name AS rule_name,
       ['not_null','range','regex','uniqueness','referential_integrity','allowed_values','length','freshness','custom_sql','median_check'][p_size % 10 + 1] AS rule_type,
       CASE WHEN p_partkey % 17 = 0 THEN '' ELSE 'p_retailprice' END AS target_column,
       p_partkey % 7 = 0 AS only_min,
       CASE p_size % 4 WHEN 0 THEN 'error' WHEN 1 THEN 'warning' WHEN 2 THEN 'info' ELSE 'critical' END AS severity,
       p_size % 5 <> 0 AS is_active,
       CAST(p_partkey % 3 AS INTEGER) AS version,
       DATE '1996-01-01' AS effective_from,
       CASE p_size % 6 WHEN 1 THEN DATE '1999-12-31' WHEN 2 THEN DATE '2005-06-30' END AS effective_to
FROM part"""

ERRORS_SQL = """concat_ws('; ',
  CASE WHEN target_column = '' THEN 'missing column' END,
  CASE WHEN NOT regexp_matches(rule_id, '^DQR-[0-9]{6,}$') THEN 'bad rule_id' END,
  CASE WHEN rule_type = 'median_check' THEN 'unknown rule_type' END,
  CASE WHEN severity = 'critical' THEN 'unknown severity' END,
  CASE WHEN version < 1 THEN 'bad version' END,
  CASE WHEN only_min AND rule_type = 'range' THEN 'missing params.max' END,
  CASE WHEN only_min AND rule_type = 'regex' THEN 'missing params.pattern' END,
  CASE WHEN only_min AND rule_type = 'allowed_values' THEN 'missing params.values' END,
  CASE WHEN only_min AND rule_type = 'length' THEN 'missing params.min_length' END,
  CASE WHEN only_min AND rule_type = 'length' THEN 'missing params.max_length' END,
  CASE WHEN only_min AND rule_type = 'referential_integrity' THEN 'missing params.ref_table' END,
  CASE WHEN only_min AND rule_type = 'referential_integrity' THEN 'missing params.ref_column' END,
  CASE WHEN only_min AND rule_type = 'freshness' THEN 'missing params.max_age_hours' END,
  CASE WHEN only_min AND rule_type = 'custom_sql' THEN 'missing params.sql_expression' END)"""


def mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping per part and return flag."""
    return (
        load(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", "l_returnflag")
        .agg(F.min("l_linenumber").alias("priority"), F.max("l_linestatus").alias("status"), F.count(F.lit(1)).alias("n"))
        .select(
            F.concat_ws("-", F.lit("MAP"), "l_returnflag", F.col("l_partkey").cast("string")).alias("mapping_id"),
            F.concat(F.lit("returns_"), "l_returnflag").alias("dataset_name"),
            F.lit("p_retailprice").alias("column_name"),
            rule_id("l_partkey").alias("rule_id"),
            F.when(F.col("n") % 2 == 0, "hard").when(F.col("n") % 3 == 0, "soft").alias("enforcement_mode"),
            F.when(F.col("priority") < 4, F.col("priority")).alias("priority"),
            (F.col("status") == "O").alias("is_active"),
        )
    )


MAPPINGS_SQL = """
SELECT 'MAP-' || l_returnflag || '-' || CAST(l_partkey AS VARCHAR) AS mapping_id,
       'returns_' || l_returnflag AS dataset_name,
       'DQR-' || lpad(CAST(l_partkey AS VARCHAR), greatest(6, length(CAST(l_partkey AS VARCHAR)))::INT, '0') AS rule_id,
       CASE WHEN count(*) % 2 = 0 THEN 'hard' WHEN count(*) % 3 = 0 THEN 'soft' END AS enforcement_mode,
       CASE WHEN min(l_linenumber) < 4 THEN min(l_linenumber) END AS priority,
       max(l_linestatus) = 'O' AS is_active
FROM lineitem GROUP BY l_partkey, l_returnflag"""


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset per supplier."""
    return load(spark, sf_dir, "supplier").select(
        F.concat(F.lit("DS-"), F.col("s_suppkey").cast("string")).alias("dataset_id"),
        F.col("s_name").alias("dataset_name"),
        F.lit("bronze.lineitem").alias("source_table"),
        F.lit("l_orderkey").alias("primary_key"),
        F.when(
            F.col("s_nationkey") % 2 == 0, F.lit('{"l_partkey_ref":{"dlt_table":"part_bronze","ref_column":"p_partkey"}}')
        ).alias("ref_tables"),
        (F.col("s_acctbal") > 0).alias("is_active"),
    )


def mappings_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping per supplier and part."""
    return (
        load(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_partkey")
        .agg(F.min("l_linenumber").alias("priority"))
        .select(
            F.concat_ws("-", F.lit("MAP"), F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string")).alias("mapping_id"),
            F.concat(F.lit("DS-"), F.col("l_suppkey").cast("string")).alias("dataset_id"),
            F.lit("p_retailprice").alias("column_name"),
            rule_id("l_partkey").alias("rule_id"),
            F.lit("soft").alias("enforcement_mode"),
            "priority",
            F.lit(True).alias("is_active"),
        )
    )


BY_ID_SQL = """
SELECT s.s_name AS dataset_name, m.rule_id, m.priority
FROM (SELECT l_suppkey, 'DQR-' || lpad(CAST(l_partkey AS VARCHAR), greatest(6, length(CAST(l_partkey AS VARCHAR)))::INT, '0') AS rule_id,
             min(l_linenumber) AS priority FROM lineitem GROUP BY l_suppkey, l_partkey) m
JOIN supplier s ON s.s_suppkey = m.l_suppkey WHERE s.s_acctbal > 0"""


def _severity() -> Column:
    return F.when(F.col("p_size") > 25, "error").otherwise("warning")


def part_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule per part."""
    return load(spark, sf_dir, "part").select(rule_id("p_partkey").alias("rule_id"), _severity().alias("severity"))


def stored_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule table before a load: one rule per part with an even key."""
    part = load(spark, sf_dir, "part").where("p_partkey % 2 = 0")
    severity = _severity()
    return part.select(
        rule_id("p_partkey").alias("rule_id"),
        F.lit(1).alias("version"),
        severity.alias("severity"),
        F.lit("1999-01-01").cast("date").alias("created_at"),
        F.lit("1999-01-01").cast("date").alias("updated_at"),
        F.sha2(F.concat_ws("|", rule_id("p_partkey"), severity), 256).alias("checksum"),
    )


def extracted_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of a new load: one per part ever shipped in a large quantity."""
    lines = load(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.max("l_quantity").alias("most"), F.count(F.lit(1)).alias("n"))
    severity = F.when(F.col("most") >= 50, "error").otherwise("warning")
    return lines.select(
        rule_id("l_partkey").alias("rule_id"),
        (F.when(F.col("n") % 5 == 0, 2).otherwise(1)).alias("version"),
        severity.alias("severity"),
        F.lit("2000-01-01").cast("date").alias("created_at"),
        F.lit("2000-01-01").cast("date").alias("updated_at"),
        F.sha2(F.concat_ws("|", rule_id("l_partkey"), severity), 256).alias("checksum"),
    )


_ID_SQL = "'DQR-' || lpad(CAST({k} AS VARCHAR), greatest(6, length(CAST({k} AS VARCHAR)))::INT, '0')"
STORED_SQL = f"""
SELECT {_ID_SQL.format(k='p_partkey')} AS rule_id, 1 AS version, CASE WHEN p_size > 25 THEN 'error' ELSE 'warning' END AS severity
FROM part WHERE p_partkey % 2 = 0"""
EXTRACTED_SQL = f"""
SELECT {_ID_SQL.format(k='l_partkey')} AS rule_id, CASE WHEN count(*) % 5 = 0 THEN 2 ELSE 1 END AS version,
       CASE WHEN max(l_quantity) >= 50 THEN 'error' ELSE 'warning' END AS severity
FROM lineitem GROUP BY l_partkey"""


def quantity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range rule per part and supplier: the quantities that supplier has shipped."""
    seen = (
        load(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.min("l_quantity").cast("int").alias("lo"), F.max("l_quantity").cast("int").alias("hi"))
    )
    return seen.select(
        F.lit("lineitem").alias("dataset_name"),
        F.concat(F.lit("quantity_of_"), F.col("l_partkey").cast("string")).alias("target_column"),
        F.lit("range").alias("rule_type"),
        F.concat_ws("-", F.lit("R"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("rule_id"),
        F.format_string('{"min":%d,"max":%d}', "lo", "hi").alias("params"),
    )


QUANTITY_SQL = """
SELECT l_partkey, 'R-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS rule_id,
       CAST(min(l_quantity) AS DOUBLE) AS lo, CAST(max(l_quantity) AS DOUBLE) AS hi
FROM lineitem GROUP BY l_partkey, l_suppkey"""


def status_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An allowed-values rule per customer and order status: the priorities seen there."""
    seen = (
        load(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.collect_set("o_orderpriority").alias("seen"))
    )
    return seen.select(
        F.lit("orders").alias("dataset_name"),
        F.concat(F.lit("priority_of_"), F.col("o_custkey").cast("string")).alias("target_column"),
        F.lit("allowed_values").alias("rule_type"),
        F.concat_ws("-", F.lit("V"), F.col("o_custkey").cast("string"), "o_orderstatus").alias("rule_id"),
        F.to_json(F.struct(F.array_sort("seen").alias("values"))).alias("params"),
    )


def rule_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule version per part and year of shipment."""
    return (
        load(spark, sf_dir, "lineitem")
        .groupBy(rule_id("l_partkey").alias("rule_id"), (F.year("l_shipdate") - 1994).alias("version"))
        .agg(F.min("l_shipdate").cast("date").alias("effective_from"))
    )
