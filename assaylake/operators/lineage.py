"""Row provenance: the ``_lineage`` struct, stamped in bronze and completed layer by layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import instant

When = str | dt.datetime | None


def bronze_stamp(df: DataFrame, table: str, fmt: str, pipeline: str, file_date: str | None = None, at: When = None) -> DataFrame:
    """Add ``_lineage`` with the real source file of each row; silver and gold are still empty.

    ``df`` must come straight from a file source, which offers the ``_metadata`` column.
    """
    moment = instant(at)
    file_date_col = (
        F.lit(file_date) if file_date else F.date_format(F.col("_metadata.file_modification_time"), "yyyy-MM-dd")
    )
    none, never = F.lit(None).cast("string"), F.lit(None).cast("timestamp")
    lineage = F.struct(
        F.struct(
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_path").alias("file_path"),
            file_date_col.alias("file_date"),
            F.lit(fmt).alias("format"),
        ).alias("source"),
        F.struct(F.lit(table).alias("table"), moment.alias("ingested_at")).alias("bronze"),
        F.struct(none.alias("table"), never.alias("validated_at")).alias("silver"),
        F.struct(none.alias("table"), never.alias("processed_at")).alias("gold"),
        F.struct(F.lit(pipeline).alias("name"), moment.alias("updated_at")).alias("pipeline"),
    )
    return df.withColumn("_lineage", lineage)


def _layer(table: str, stamp: str, at: When) -> Column:
    return F.struct(F.lit(table).alias("table"), instant(at).alias(stamp))


def silver_enrich(df: DataFrame, table: str, at: When = None) -> DataFrame:
    """Fill the silver part; a frame without ``_lineage`` is returned as it is."""
    if "_lineage" not in df.columns:
        return df
    return df.withColumn("_lineage", F.col("_lineage").withField("silver", _layer(table, "validated_at", at)))


def gold_enrich(df: DataFrame, table: str, at: When = None) -> DataFrame:
    """Fill the gold part; a frame without ``_lineage`` is returned as it is."""
    if "_lineage" not in df.columns:
        return df
    return df.withColumn("_lineage", F.col("_lineage").withField("gold", _layer(table, "processed_at", at)))
