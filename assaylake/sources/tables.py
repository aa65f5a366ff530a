"""Reading and writing tables: CSV, Parquet and catalogue tables in; overwrite and append out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Schema = T.StructType | str


def read_csv(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    """CSV with a header. Without a schema Spark infers one, which reads the files twice."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


# Columns of a landed CSV beside its own: the text of a record that does not fit the schema, and its file.
BROKEN, FILE = "_corrupt_record", "_source_file"


def landing_csv(spark: SparkSession, path: str, schema: T.StructType, stream: bool = False, header: bool = True) -> DataFrame:
    """CSV files as a batch or a stream of files: all columns, and the text of records that do not fit. Store it
    (:func:`land`, or a stream's sink) before it is split: what Spark finds broken depends on the columns that are read."""
    reader = (spark.readStream if stream else spark.read).option("header", header).option("mode", "PERMISSIVE")
    whole = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    return reader.option("columnNameOfCorruptRecord", BROKEN).schema(whole).csv(path).select("*", F.col("_metadata.file_path").alias(FILE))


def land(spark: SparkSession, path: str, schema: T.StructType, into: str, header: bool = True) -> DataFrame:
    """Read CSV files once and store them, broken records included."""
    return write_overwrite(landing_csv(spark, path, schema, header=header), into)


def fitting(landed: DataFrame) -> DataFrame:
    """The records that fit the schema."""
    return landed.where(F.col(BROKEN).isNull()).drop(BROKEN, FILE)


def rescued(landed: DataFrame) -> DataFrame:
    """The records that do not: ``record`` (their text), ``source_file`` and ``reason``: the fields that are not of their
    column's type, else the number of fields."""
    own = [f for f in landed.schema if f.name not in (BROKEN, FILE)]
    plain = T.StructType([T.StructField(f.name, T.StringType()) for f in own])
    fields = F.from_csv(F.col(BROKEN), plain.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
    wrong = []
    for f in own:
        value = F.col(f"__f.`{f.name}`")
        kind = f.dataType.simpleString()
        misfit = value.isNotNull() & (value != "") & value.try_cast(f.dataType).isNull()
        wrong.append(F.when(misfit, F.concat(F.lit(f"{f.name} is not {kind}: "), value)))
    reason = F.concat_ws("; ", *wrong)
    rows = landed.where(F.col(BROKEN).isNotNull()).withColumn("__f", fields)
    named = F.when(reason == "", F.lit(f"not {len(own)} fields")).otherwise(reason)
    return rows.select(F.col(BROKEN).alias("record"), F.col(FILE).alias("source_file"), named.alias("reason"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalogue table, or a Parquet folder if the name is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def write_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Full refresh; the new schema replaces the old one. Returns a reader of the stored table."""
    df.write.mode("overwrite").option("overwriteSchema", True).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_run(df: DataFrame, path: str, run_column: str = "run_id") -> None:
    """Append the rows of a run; a rerun replaces its own rows and leaves other runs alone."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(run_column)
        .parquet(path)
    )


def append_merging(df: DataFrame, path: str) -> None:
    """Append rows whose columns may differ from the stored ones; readers merge the schemas."""
    df.write.mode("append").parquet(path)


def read_merging(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def union_merging(stored: DataFrame, df: DataFrame) -> DataFrame:
    """Rows of both; columns missing on a side are NULL."""
    return stored.unionByName(df, allowMissingColumns=True)


def truncate(spark: SparkSession, path: str, schema: Schema) -> None:
    """Empty a table and keep its schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def without_runs(df: DataFrame, run_ids: Sequence[str], run_column: str = "run_id") -> DataFrame:
    """All rows but those of some runs, to be written to a new folder."""
    return df.where(~F.col(run_column).isin(list(run_ids)))
