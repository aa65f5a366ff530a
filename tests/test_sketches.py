"""Merged profiles against exact figures."""

from collections import Counter

from pyspark.sql import functions as F

from assaylake.operators import sketches


def table(spark):
    n = F.when(F.col("id") % 50 == 0, None).otherwise((F.col("id") * 7919) % 6007)
    return spark.range(40_000).select(
        "id", F.when(F.col("id") % 3 == 0, "mon").when(F.col("id") % 3 == 1, "tue").alias("day"), n.alias("n"),
        F.when(F.col("id") % 7 == 0, "often").otherwise(F.concat(F.lit("v"), F.col("id") % 2000)).alias("s"),
    ).repartition(6)


def stored(spark, tmp_path, make, name):
    make(table(spark), "day").write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def test_merged_figures_keep_their_bounds(spark, tmp_path):
    parts = stored(spark, tmp_path, sketches.sketch_parts, "sketches")
    assert parts.count() == 9  # three days, one of them NULL, and three columns
    for days in (F.lit(True), F.col("part") == "mon", F.col("part").isNull()):
        rows = table(spark).withColumnRenamed("day", "part").where(days).collect()
        found = {r.column: r for r in sketches.merged_profile(parts.where(days), at=(0.1, 0.5, 0.9)).collect()}
        for name in ("id", "n", "s"):
            values, r = [v[name] for v in rows if v[name] is not None], found[name]
            assert (r.rows, r.nulls) == (len(rows), len(rows) - len(values))
            assert r.distinct_low <= len(set(values)) <= r.distinct_high
            assert (r.min_value, r.max_value) == (str(min(values)), str(max(values)))
            for q, v in zip((0.1, 0.5, 0.9), r.quantiles or []):
                below, upto = sum(x < v for x in values) / len(values), sum(x <= v for x in values) / len(values)
                assert below <= q + sketches.RANK_ERROR and upto >= q - sketches.RANK_ERROR
    assert sketches.merged_profile(parts.where("false")).count() == 0


def test_frequent_values_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sketches, "FREQUENT", 100)
    parts, frequent = (stored(spark, tmp_path, make, n) for make, n in ((sketches.sketch_parts, "s"), (sketches.frequent_parts, "f")))
    exact = {c: Counter(r[c] for r in table(spark).collect()) for c in ("n", "s")}
    found = sketches.merged_frequent(frequent, parts).collect()
    for r in found:
        assert r.at_least <= exact[r.column][int(r.value) if r.column == "n" else r.value] <= r.at_most
    assert {r.value for r in found if r.column == "s"} >= {v for v, k in exact["s"].items() if k * 100 > 40_000}
    assert frequent.groupBy("part", "column").count().agg(F.max("count")).first()[0] <= 100


def test_suggestions_from_bounds(spark):
    parts = sketches.sketch_parts(table(spark), "day")
    found = {(r.target_column, r.rule_type): r for r in sketches.suggest_with_bounds(sketches.merged_profile(parts), "d").collect()}
    assert set(found) == {("id", "not_null"), ("id", "uniqueness"), ("id", "range"), ("n", "range"), ("s", "not_null")}
    assert found["id", "uniqueness"].basis == "likely" and found["id", "range"].params == '{"min":0,"max":39999}'
