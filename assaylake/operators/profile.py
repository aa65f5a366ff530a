"""Profiling a table in one pass, rules suggested from the profile, and reconciliation between tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def _simple(df: DataFrame, columns: Sequence[str] | None) -> list[T.StructField]:
    wanted = set(columns or df.columns)
    return [f for f in df.schema.fields if f.name in wanted and isinstance(f.dataType, T.AtomicType)]


def profile(df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.02) -> DataFrame:
    """Per column: rows, NULLs, approximate distinct values, least and greatest value, text lengths, median.

    One aggregate over the scan; nothing is shuffled but one row per task.
    """
    fields = _simple(df, columns)
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        text = c.cast("string")
        aggs += [
            F.count_if(c.isNull()).alias(f"null{i}"),
            F.approx_count_distinct(c, rsd).alias(f"distinct{i}"),
            F.min(c).cast("string").alias(f"min{i}"),
            F.max(c).cast("string").alias(f"max{i}"),
            F.min(F.length(text)).alias(f"minlen{i}"),
            F.max(F.length(text)).alias(f"maxlen{i}"),
        ]
        if isinstance(f.dataType, T.NumericType):
            aggs.append(F.percentile_approx(c, 0.5, 10_000).cast("double").alias(f"median{i}"))
    lines = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("n").alias("rows"),
            F.col(f"null{i}").alias("nulls"),
            F.when(F.col("n") > 0, F.col(f"null{i}") * 100 / F.col("n")).alias("null_pct"),
            F.col(f"distinct{i}").alias("approx_distinct"),
            F.col(f"min{i}").alias("min_value"),
            F.col(f"max{i}").alias("max_value"),
            F.col(f"minlen{i}").alias("min_length"),
            F.col(f"maxlen{i}").alias("max_length"),
            (F.col(f"median{i}") if isinstance(f.dataType, T.NumericType) else F.lit(None).cast("double")).alias("median"),
        )
        for i, f in enumerate(fields)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*lines)))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact counts per (column, value); counting starts before the shuffle."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def exact_distinct(counts: DataFrame) -> DataFrame:
    """Exact distinct values, NULLs and the most frequent value per column from :func:`value_counts`.

    Spark folds the counts on the map side, so a column with very many values is never gathered in one task.
    """
    known = F.col("value").isNotNull()
    ranked = F.struct(F.col("n").alias("n"), F.col("value").alias("value"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("nulls"),
        F.count_if(known).alias("distinct"),
        F.max(F.when(known, ranked)).alias("top"),
    ).select("column", "rows", "nulls", "distinct", F.col("top.value").alias("top_value"), F.col("top.n").alias("top_count"))


def top_values(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values per column. The rank filter also runs before the shuffle, so each task
    sends at most ``k`` rows per column."""
    order = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def suggest_rules(profiled: DataFrame, dataset: str) -> DataFrame:
    """Rule candidates from a profile, for a steward to accept.

    not_null for columns without NULLs, uniqueness where (nearly) every value differs, range for numbers,
    length for text.
    """
    numeric = F.col("type").isin("tinyint", "smallint", "int", "bigint", "float", "double") | F.col("type").startswith("decimal")
    rules = F.array_compact(
        F.array(
            F.when(F.col("nulls") == 0, _candidate("not_null", F.lit("{}"))),
            F.when(
                (F.col("nulls") == 0) & (F.col("approx_distinct") >= F.col("rows") * 0.95) & (F.col("rows") > 1),
                _candidate("uniqueness", F.lit('{"scope":"table"}')),
            ),
            F.when(
                numeric & F.col("min_value").isNotNull(),
                _candidate("range", F.concat(F.lit('{"min":'), F.col("min_value"), F.lit(',"max":'), F.col("max_value"), F.lit("}"))),
            ),
            F.when(
                (F.col("type") == "string") & F.col("min_length").isNotNull(),
                _candidate(
                    "length",
                    F.concat(F.lit('{"min_length":'), F.col("min_length"), F.lit(',"max_length":'), F.col("max_length"), F.lit("}")),
                ),
            ),
        )
    )
    return profiled.select(F.lit(dataset).alias("dataset_name"), F.col("column").alias("target_column"), F.inline(rules))


def _candidate(kind: str, params: Column) -> Column:
    return F.struct(F.lit(kind).alias("rule_type"), params.alias("params"))


def reconcile(
    parent: DataFrame,
    child: DataFrame,
    *,
    parent_key: str,
    child_key: str,
    parent_value: Column,
    child_value: Column,
    tolerance: float = 0.005,
) -> DataFrame:
    """Does a parent's total equal the sum over its children?

    Children are summed per key before the join, so a parent with very many children is one row of it. Parents
    without children are compared with zero; children without a parent are listed with a NULL expectation.
    Sums are exact decimals.
    """
    money = "decimal(28,4)"
    expected = parent.select(F.col(f"`{parent_key}`").alias("key"), parent_value.cast(money).alias("expected"))
    actual = child.groupBy(F.col(f"`{child_key}`").alias("key")).agg(
        F.sum(child_value.cast(money)).alias("actual"), F.count(F.lit(1)).alias("children")
    )
    # A left join and an anti join instead of a full one: Spark can split a hot key of a left join over tasks.
    listed = expected.join(actual, "key", "left")
    orphans = actual.join(expected.select("key"), "key", "left_anti")
    both = listed.unionByName(orphans, allowMissingColumns=True)
    difference = F.coalesce("expected", F.lit(0).cast(money)) - F.coalesce("actual", F.lit(0).cast(money))
    status = (
        F.when(F.col("expected").isNull(), "no_parent")
        .when(F.col("children").isNull(), "no_children")
        .when(F.abs(difference) <= F.lit(tolerance).cast(money), "match")
        .otherwise("mismatch")
    )
    return both.select(
        "key",
        F.col("expected").cast("double").alias("expected"),
        F.col("actual").cast("double").alias("actual"),
        F.coalesce("children", F.lit(0)).alias("children"),
        difference.cast("double").alias("difference"),
        status.alias("status"),
    )
