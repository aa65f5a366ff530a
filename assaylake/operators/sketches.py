"""Profiles that are kept per part of a table (a day, a load) and merged for any range of parts without reading rows.

Stored are counts, extremes, a sketch of the distinct values, one of the quantiles, and the frequent values with their exact
counts. Everything merges; what is approximate comes with bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.functions.columns import percent

# Size of the distinct sketch (2**14 registers: a standard error of 0.8 %) and of the quantile sketch.
REGISTERS, KLL = 14, 400
# Three standard errors of the distinct count, as a share of it, and the rank error of quantiles.
DISTINCT_ERROR, RANK_ERROR = 0.025, 0.01
# A value is frequent in a part if it is in more than one in FREQUENT of its rows, so at most FREQUENT values are.
FREQUENT = 1000


def _profiled(df: DataFrame, part: str, columns: Sequence[str] | None) -> list[T.StructField]:
    wanted = set(columns or df.columns)
    return [f for f in df.schema.fields if f.name in wanted and f.name != part and isinstance(f.dataType, T.AtomicType)]


def sketch_parts(df: DataFrame, part: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per part and column: ``part``, ``column``, ``type``, ``rows``, ``nulls``, least and greatest value, text lengths,
    ``distinct`` and ``quantiles`` (sketches; the latter of numbers only). One aggregate over the scan."""
    fields = _profiled(df, part, columns)
    none, aggs, lines = F.lit(None), [F.count(F.lit(1)).alias("n")], []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        text, number = c.cast("string"), isinstance(f.dataType, T.NumericType)
        aggs += [
            F.count_if(c.isNull()).alias(f"null{i}"),
            F.min(c).cast("string").alias(f"min{i}"),
            F.max(c).cast("string").alias(f"max{i}"),
            F.min(F.length(text)).alias(f"minlen{i}"),
            F.max(F.length(text)).alias(f"maxlen{i}"),
            F.hll_sketch_agg(text, REGISTERS).alias(f"hll{i}"),
        ]
        if number:
            aggs += [F.kll_sketch_agg_double(c.cast("double"), KLL).alias(f"kll{i}"), F.min(c).cast("double").alias(f"low{i}"), F.max(c).cast("double").alias(f"high{i}")]
        lines.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col("n").alias("rows"),
                F.col(f"null{i}").alias("nulls"),
                F.col(f"min{i}").alias("min_value"),
                F.col(f"max{i}").alias("max_value"),
                (F.col(f"low{i}") if number else none.cast("double")).alias("low"),
                (F.col(f"high{i}") if number else none.cast("double")).alias("high"),
                F.col(f"minlen{i}").alias("min_length"),
                F.col(f"maxlen{i}").alias("max_length"),
                F.col(f"hll{i}").alias("distinct"),
                (F.col(f"kll{i}") if number else none.cast("binary")).alias("quantiles"),
            )
        )
    counted = df.groupBy(F.col(f"`{part}`").alias("part")).agg(*aggs)
    return counted.select("part", F.inline(F.array(*lines)))


def frequent_parts(df: DataFrame, part: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The frequent values of every part and column with their exact counts: ``part``, ``column``, ``value``, ``n``. Counting starts
    before the shuffle, and a part and column keeps FREQUENT values at most."""
    fields = _profiled(df, part, columns)
    pairs = [F.struct(F.lit(f.name).alias("column"), F.col(f"`{f.name}`").cast("string").alias("value")) for f in fields]
    own = F.col(f"`{part}`").alias("part")
    counts = df.select(own, F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).groupBy("part", "column", "value").agg(F.count(F.lit(1)).alias("n"))
    rows = df.groupBy(own).agg(F.count(F.lit(1)).alias("rows")).withColumnRenamed("part", "of")
    return counts.join(rows, F.col("part").eqNullSafe(F.col("of"))).where(F.col("n") * FREQUENT > F.col("rows")).drop("of", "rows")


def merged_profile(sketches: DataFrame, at: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The profile of all parts given, one row per column. ``approx_distinct`` lies within ``distinct_low`` and
    ``distinct_high``; a quantile's rank is off by RANK_ERROR at most."""
    numeric = F.col("low").isNotNull()
    merged = sketches.groupBy("column", "type").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("min_value").alias("min_text"),
        F.max("max_value").alias("max_text"),
        F.min("min_length").alias("min_length"),
        F.max("max_length").alias("max_length"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct", True)).alias("approx_distinct"),
        F.kll_merge_agg_double("quantiles").alias("kll"),
        F.min_by("min_value", "low").alias("min_number"),
        F.max_by("max_value", "high").alias("max_number"),
    )
    off = F.col("approx_distinct") * DISTINCT_ERROR
    quantiles = F.when(numeric, F.array(*[F.kll_sketch_get_quantile_double("kll", F.lit(float(q))) for q in at]))
    return merged.select(
        "column",
        "type",
        "rows",
        "nulls",
        percent(F.col("nulls"), F.col("rows"), 0.0, None).alias("null_pct"),
        "approx_distinct",
        F.floor(F.col("approx_distinct") - off).alias("distinct_low"),
        F.ceil(F.col("approx_distinct") + off + 1).alias("distinct_high"),
        F.when(numeric, F.col("min_number")).otherwise(F.col("min_text")).alias("min_value"),
        F.when(numeric, F.col("max_number")).otherwise(F.col("max_text")).alias("max_value"),
        "min_length",
        "max_length",
        quantiles.alias("quantiles"),
    )


def merged_frequent(frequent: DataFrame, sketches: DataFrame) -> DataFrame:
    """Per column the values that are frequent in some part: ``at_least`` rows, counted where the value is frequent, and
    ``at_most``, with what the other parts can hold unseen. A value in more than one in FREQUENT rows of all parts is listed."""
    room = F.floor(F.col("rows") / FREQUENT)
    parts = sketches.groupBy("column").agg(F.sum(room).alias("room"))
    listed = frequent.join(sketches.select(F.col("part").alias("of"), F.col("column").alias("its"), room.alias("own")), F.col("part").eqNullSafe(F.col("of")) & (F.col("column") == F.col("its")))
    counted = listed.groupBy("column", "value").agg(F.sum("n").alias("at_least"), F.sum("own").alias("counted"))
    return counted.join(parts, "column").select(
        "column", "value", "at_least", (F.col("at_least") + F.col("room") - F.col("counted")).alias("at_most")
    )


def suggest_with_bounds(profiled: DataFrame, dataset: str) -> DataFrame:
    """Rule candidates from a merged profile. Uniqueness is suggested if, within its bounds, the distinct count may be that of the
    rows; its ``basis`` is "likely", since a sketch cannot prove it, and "exact" for the others."""
    whole = (F.col("nulls") == 0) & (F.col("rows") > 1)
    rules = F.array_compact(
        F.array(
            F.when(F.col("nulls") == 0, _suggested("not_null", F.lit("{}"), "exact")),
            F.when(whole & (F.col("distinct_high") >= F.col("rows")), _suggested("uniqueness", F.lit('{"scope":"table"}'), "likely")),
            F.when(
                F.col("quantiles").isNotNull(),
                _suggested("range", F.concat(F.lit('{"min":'), F.col("min_value"), F.lit(',"max":'), F.col("max_value"), F.lit("}")), "exact"),
            ),
        )
    )
    return profiled.select(F.lit(dataset).alias("dataset_name"), F.col("column").alias("target_column"), F.inline(rules))


def _suggested(kind: str, params: Column, basis: str) -> Column:
    return F.struct(F.lit(kind).alias("rule_type"), params.alias("params"), F.lit(basis).alias("basis"))
