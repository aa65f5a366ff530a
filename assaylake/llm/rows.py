"""Carrying whole input rows through an operator, whatever their columns are called."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wrap(docs: DataFrame, key: str, text: str) -> DataFrame:
    """`whole` (all columns), `doc_id` and `text`."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return docs.select(whole.alias("whole"), F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))


def unwrap(wrapped: DataFrame) -> DataFrame:
    return wrapped.select("whole.*")
