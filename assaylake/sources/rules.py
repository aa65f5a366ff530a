"""Reading rules, mappings and dataset registries from JSON documents or tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake import schemas


def _read_list(spark: SparkSession, path: str, field: str, item: T.StructType) -> DataFrame:
    schema = T.StructType([T.StructField(field, T.ArrayType(item))])
    document = spark.read.schema(schema).option("multiLine", True).json(path)
    return document.select(F.inline(field))


def read_rules_json(spark: SparkSession, path: str) -> DataFrame:
    """``{"rules": [...]}`` as one row per rule; ``params`` stays JSON text whatever its shape."""
    return _read_list(spark, path, "rules", schemas.RAW_RULE)


def read_mappings_json(spark: SparkSession, path: str) -> DataFrame:
    """``{"mappings": [...]}`` as one row per mapping."""
    return _read_list(spark, path, "mappings", schemas.MAPPINGS)


def read_rules_table(spark: SparkSession, table: str) -> DataFrame:
    """Rules from a table; ``target_column`` is also offered as ``column``, missing params as ``{}``."""
    rules = spark.read.parquet(table) if "/" in table else spark.table(table)
    if "target_column" in rules.columns and "column" not in rules.columns:
        rules = rules.withColumn("column", F.col("target_column"))
    return rules.withColumn("params", F.coalesce(F.nullif(F.col("params"), F.lit("")), F.lit("{}")))


def read_rules(spark: SparkSession, table: str, json_path: str) -> DataFrame:
    """The rule table if it exists, else the JSON document."""
    if spark.catalog.tableExists(table):
        return read_rules_table(spark, table)
    return read_rules_json(spark, json_path)


def read_mappings(spark: SparkSession, table: str, json_path: str) -> DataFrame:
    """The mapping table if it exists, else the JSON document."""
    return spark.table(table) if spark.catalog.tableExists(table) else read_mappings_json(spark, json_path)


REF_TABLES = "map<string,struct<dlt_table:string,ref_column:string>>"


def registry_references(datasets: DataFrame) -> DataFrame:
    """One row per (dataset, reference) from the JSON column ``ref_tables`` of the registry."""
    refs = datasets.select(
        "dataset_id", "dataset_name", F.explode(F.from_json("ref_tables", REF_TABLES)).alias("ref_name", "ref")
    )
    return refs.select(
        "dataset_id",
        "dataset_name",
        "ref_name",
        F.col("ref.dlt_table").alias("ref_table"),
        F.col("ref.ref_column").alias("ref_column"),
    )
