"""A training corpus from `documents`: quality rules, near duplicates, personal data, packing.

Every stage works on all that the one before it kept, and is one of the operators of `assaylake.llm` with production
parameters. Between stages the rows are stored as Parquet in the shared folder, so a lost executor costs a stage's tasks
at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm import jaccard_join, packing, perplexity, surrogates
from assaylake.llm.registered import SEQUENCE, SURROGATE_KEY, vocabulary_path
from assaylake.llm.shipping import ship
from assaylake.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their language's perplexity band keep."""
    ship(spark)
    return perplexity.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that shingle similarity connects."""
    ship(spark)
    return jaccard_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets; n_chars is that of the new text."""
    replaced, _ = surrogates.replace(docs, SURROGATE_KEY)
    return replaced.withColumn("n_chars", F.length("text").cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' tokens in training sequences."""
    ship(spark)
    return packing.pack(docs, vocabulary_path(), SEQUENCE, end=0)


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("personal data", personal_data), ("packing", pack)]

#: No SQL: perplexity and surrogates have none. tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over `documents`; the rows of the last one."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        df = settle(stage(spark, df, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, df, sf_dir)
